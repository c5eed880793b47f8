import random

from pyspark.sql import functions as F

from ledgerloom.operators import cascade, observe, vote

CELL = "doc_id string, page_no int, voter string, voter_ord int, cell_idx int, text string, confidence double, bbox struct<l:double,t:double,r:double,b:double>, from_ocr boolean"


def cells(spark, rows):
    return spark.createDataFrame([("d", p, f"v{v}", v, i, t, c, b, True) for p, v, i, t, c, b in rows], CELL)


def test_column_that_one_voter_lost(spark):
    rows = [(1, v, i, "x", 0.9, (x, 10.0, x + 20, 20.0)) for v in range(3) for i, x in enumerate((90.0, 490.0))] + [(1, 3, 0, "x", 0.9, (290.0, 10.0, 310.0, 20.0))]
    assert [r.voter for r in vote.column_drop(cells(spark, rows)).collect()] == ["v3"]


def test_seven_voters_commit_two_clusters(spark):
    rows = [(1, v, i, t, 0.9, (x, 0.0, x + 20, 10.0)) for v in range(7) for i, (t, x) in enumerate((("12 345", 50.0), ("Sum", 400.0)))]
    got = vote.bbox_vote(cells(spark, rows)).collect()
    assert [(r.consensus_text, r.n_hit, r.committed, r.confidence) for r in sorted(got, key=lambda r: r.cluster_no)] == [("12 345", 7, True, 1.0), ("Sum", 7, True, 1.0)]


def test_minority_reading_is_an_alternative(spark):
    rows = [(1, v, 0, t, 0.9, (0.0, 0.0, 20.0, 10.0)) for v, t in enumerate(["8", "3", "3", "8", "8"])]
    (r,) = vote.bbox_vote(cells(spark, rows), min_voters=3).collect()
    assert (r.consensus_text, r.voters_hit, [tuple(a) for a in r.alternatives]) == ("8", ["v0", "v3", "v4"], [("3", ["v1", "v2"])])


def plain_clusters(page, least=0.3):
    """The greedy rule written down directly."""
    out = []
    for v, i, b in sorted(page):
        for k in out:
            hit = False
            for _, _, o in k:
                w, h = min(b[2], o[2]) - max(b[0], o[0]), min(b[3], o[3]) - max(b[1], o[1])
                if w > 0 and h > 0:
                    area = lambda z: max(1.0, (z[2] - z[0]) * (z[3] - z[1]))
                    hit |= w * h / (area(b) + area(o) - w * h) >= least
            if hit:
                if all(o[0] != v for o in k):
                    k.append((v, i, b))
                break
        else:
            out.append([(v, i, b)])
    return [[(v, i) for v, i, _ in k] for k in out]


def test_clusters_on_random_pages(spark):
    rng = random.Random(9)
    pages, rows = {}, []
    for p in range(40):
        for v in range(rng.randint(1, 5)):
            for i in range(rng.randint(0, 12)):
                x, y = rng.randint(0, 40), rng.randint(0, 30)
                b = (float(x), float(y), float(x + rng.randint(0, 15)), float(y + rng.randint(0, 8)))
                pages.setdefault(p, []).append((v, i, b))
                rows.append((p, v, i, "t", 0.5, b))
    got = {}
    for r in vote.clusters(cells(spark, rows)).collect():
        got.setdefault(r.page_no, {})[r.cluster_no] = [(m.voter_ord, m.cell_idx) for m in r.members]
    assert {p: plain_clusters(c) for p, c in pages.items()} == {p: [k[n] for n in sorted(k)] for p, k in got.items()}


def test_line_and_word_cells_meet(spark):
    words = ["Sum", "eiendeler", "12", "345", "678"]
    rows = [(1, 0, 0, "Sum eiendeler 12 345 678", 0.9, (0.0, 2.0, 200.0, 18.0))] + [(1, 1, i, w, 0.9, (i * 40.0, 2.0, i * 40 + 30.0, 18.0)) for i, w in enumerate(words)]
    t = vote.voter_tokens(cells(spark, rows))
    (r,) = vote.token_vote(t.select("doc_id", "page_no", "voter", F.explode("numbers").alias("token")), t, min_voters=2).collect()
    assert (r.token, r.unanimous) == (12345678, True)


def test_lines_by_running_mean(spark):
    rng = random.Random(2)
    rows = [(1, 0, i, f"w{i}", 0.9, (float(rng.randint(0, 300)), float(y), float(rng.randint(301, 400)), float(y + rng.randint(4, 20)))) for i, y in enumerate(rng.choices(range(0, 300), k=60))]
    order = sorted(((b[1] + b[3]) / 2, i, (b[0] + b[2]) / 2, max(1.0, b[3] - b[1]), t) for _, _, i, t, _, b in rows)
    lines = []
    for y, i, x, h, t in order:
        if lines:
            ys, hs = [c[0] for c in lines[-1]], [c[1] for c in lines[-1]]
            if abs(y - sum(ys) / len(ys)) <= 0.5 * min(h, sum(hs) / len(hs)):
                lines[-1].append((y, h, x, i, t))
                continue
        lines.append([(y, h, x, i, t)])
    text = "\n".join(" ".join(c[4] for c in sorted(k, key=lambda c: (c[2], c[3]))) for k in lines)
    assert vote.joined_lines(cells(spark, rows)).first().text == text


def test_two_lines_and_nothing(spark):
    rows = [(1, 0, i, w, 0.9, (i * 40.0, y, i * 40 + 30.0, y + 16)) for i, (w, y) in enumerate((("a", 2.0), ("b", 2.0), ("c", 200.0)))]
    assert vote.joined_lines(cells(spark, rows)).first().text == "a b\nc"
    assert vote.bbox_vote(cells(spark, [])).count() == 0 and vote.joined_lines(cells(spark, [])).count() == 0


def test_nulls_take_no_part(spark):
    rows = [(1, 0, 0, None, None, (0.0, 0.0, 9.0, 9.0)), (1, 1, 0, "x", 0.5, None), (1, 2, 0, "x", 0.5, (0.0, None, 1.0, 1.0))]
    assert [r.consensus_text for r in vote.bbox_vote(cells(spark, rows), min_voters=1).collect()] == [""]


def test_sample_prefers_confidence_then_name(spark):
    rows = [(1, v, 0, "kr 1 234", c, (0.0, 0.0, 9.0, 9.0)) for v, c in enumerate((0.5, 0.9, 0.9))]
    c = cells(spark, rows)
    won = vote.token_vote(c.select("doc_id", "page_no", "voter", F.lit(1234).cast("long").alias("token")), c, min_voters=3)
    r = vote.sample_cells(won, c).first()
    assert (r.sample.voter, r.sample.text) == ("v1", "kr 1 234")
    (k,) = vote.consensus_cells(vote.sample_cells(won, c)).collect()
    assert (k.text, k.confidence) == ("kr 1 234", 1.0)
    assert vote.vote_counts(won).first().n_unanimous == 1


def test_second_pass_only_where_open(spark):
    box = (0.0, 0.0, 9.0, 9.0)
    eager = cells(spark, [(1, 0, 0, "a", 0.9, box), (1, 1, 0, "b", 0.9, box), (2, 0, 0, "c", 0.9, box), (2, 1, 0, "c", 0.9, box)])
    lazy = cells(spark, [(1, 2, 0, "b", 0.9, box), (2, 2, 0, "x", 0.9, box)])
    got = {r.page_no: (r.consensus_text, r.n_hit, r.n_attempted) for r in cascade.lazy_vote(eager, lazy, 2, veto=False).collect()}
    assert got == {1: ("b", 2, 3), 2: ("c", 2, 2)}


def test_effective_voters_and_presets(spark):
    df = spark.createDataFrame([(1, ["tesseract", "docling_default", "doctr"])], "k int, v array<string>")
    r = cascade.effective_voters(df, ["k"], "v", [["tesseract", "docling_default"]]).first()
    assert (r.n_voters, r.n_effective) == (3, 2)
    assert cascade.preset("auditor_report").min_voters == 2 and len(observe.build_observers(list(cascade.preset("tx_log").observers))) == 6
    try:
        cascade.preset("nothing")
        raise AssertionError
    except ValueError as e:
        assert "tx_log" in str(e)


def test_disagreement_boxes(spark):
    b = "struct<l:double,t:double,r:double,b:double>"
    df = spark.createDataFrame([("d", 1, 1, 2, (0.0, 0.0, 5.0, 5.0)), ("d", 1, 2, 2, (0.01, 0.0, 5.0, 5.0)), ("d", 1, 3, 9, (9.0, 9.0, 10.0, 10.0)), ("d", 1, 4, 1, (0.0, 0.0, 0.0, 5.0)), ("d", 1, 5, 1, None)], f"doc_id string, page_no int, id int, n_hit int, bbox {b}")
    assert [r.id for r in cascade.disagreement_boxes(df, 7, "id").collect()] == [1]


def test_engine_words(spark):
    box = "struct<l:double,t:double,r:double,b:double>"
    df = spark.createDataFrame([(1, 1, "Sum ", "90", (0.0, 0.0, 5.0, 5.0)), (1, 2, "eiendeler", "80", (6.0, 0.0, 9.0, 6.0)), (1, 3, " ", "99", (0.0, 0.0, 1.0, 1.0)), (2, 4, "x", "-1", (0.0, 0.0, 1.0, 1.0)), (2, 5, "y", "n/a", (0.0, 0.0, 1.0, 1.0))], f"line int, w int, text string, conf string, bbox {box}")
    (r,) = observe.lines_of_words(df, ["line"], "w", "text", "conf", "bbox", left=F.lit(10.0), first_seen=True, clamp=True).collect()
    assert (r.text, r.confidence, r.bbox.l, r.bbox.r, r.bbox.b) == ("Sum eiendeler", 0.85, 10.0, 19.0, 6.0)
    assert observe.words_as_cells(df, "text", "conf").count() == 2


def test_observer_that_fails(spark):
    import pandas as pd

    def run(page):
        if page["page_no"].iloc[0] == 2:
            raise RuntimeError("no engine")
        return pd.DataFrame({"page_no": page["page_no"], "text": ["seen"]})

    df = spark.createDataFrame([(1,), (2,), (3,)], "page_no int")
    assert sorted(r.page_no for r in observe.run_observer(df, run, "page_no int, text string").collect()) == [1, 3]
