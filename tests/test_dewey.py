import json

import pytest

from ledgerloom.operators import dewey
from ledgerloom.plans import problems

ROWS = [
    (1, json.dumps({"noter": [{"nr": 1, "poster": [{"b": 1}, None, 5, {"b": 2, "delposter": '[{"x": 1}]'}]}, "text", {"nr": 2}], "andre": {"c": 1}})),
    (2, json.dumps({"noter": {"nr": 9, "poster": {"b": 3}}})),
    (3, '{"noter": [{"nr": 1}'),
    (4, None),
    (5, ""),
    (6, json.dumps(json.dumps({"noter": [{"nr": 4}]}))),
    (7, '{"a": [[{"q": 1}], [1, 2]], "b": []}'),
    (8, "17"),
    (9, '[{"k": 1}]'),
]
EXPECTED = {
    (1, "noter[0]", "$"), (1, "noter[0].poster[0]", "noter[0]"), (1, "noter[0].poster[3]", "noter[0]"), (1, "noter[0].poster[3].delposter[0]", "noter[0].poster[3]"), (1, "noter[2]", "$"),
    (2, "noter[0]", "$"), (2, "noter[0].poster[0]", "noter[0]"), (6, "noter[0]", "$"), (7, "a[0][0]", "$"), (9, "[0]", "$"),
}


def found(df):
    return sorted(tuple(r) for r in dewey.element_links(df, "id").collect())


def test_elements_and_parents(spark):
    df = spark.createDataFrame(ROWS, "id long, j string")
    assert found(dewey.label_nodes(df, "id", "j")) == sorted(EXPECTED)


def test_names_from_a_join_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, "id long, j string")
    monkeypatch.setattr(dewey, "NAMES_IN_PLAN", 0)
    assert found(dewey.label_nodes(df, "id", "j")) == sorted(EXPECTED)


def test_brute_force_on_filings(spark, data):
    """An independent recursive walk over the smallest table."""
    df = spark.read.parquet(f"{data}/brreg_filings.parquet").select("rec_id", "raw_response")
    rows = df.collect()
    names = {"noter", "poster", "delposter", "styre", "perioder", "adresser", "anmerkninger", "sammenligning"}
    out = []

    def hold(v):
        while isinstance(v, str) and v.strip()[:1] in ("{", "[", '"'):
            try:
                v = json.loads(v)
            except ValueError:
                break
        return v

    def walk(rec, v, path, parent):
        v = hold(v)
        if isinstance(v, dict):
            for k, x in v.items():
                x = hold(x)
                if isinstance(x, dict) and k in names:
                    x = [x]
                walk(rec, x, f"{path}.{k}" if path else k, parent)
        elif isinstance(v, list):
            for i, x in enumerate(v):
                x, here = hold(x), f"{path}[{i}]"
                if isinstance(x, dict):
                    out.append((rec, here, parent))
                walk(rec, x, here, here if isinstance(x, dict) else parent)

    for r in rows:
        try:
            v = json.loads(r.raw_response) if r.raw_response else None
        except ValueError:
            continue
        if v is not None:
            walk(r.rec_id, v, "", "$")
    assert sorted(tuple(r) for r in dewey.element_links(dewey.label_nodes(df, "rec_id", "raw_response", names), "rec_id").collect()) == sorted(out)


def test_flat_table_links_and_clashing_members(spark):
    df = spark.createDataFrame([(1, json.dumps({"a": [{"id": "x", "v": 1, "b": [{"v": 2}]}]}), "other")], "id long, j string, node_path string")
    nodes = dewey.label_nodes(df, "id", "j")
    (r,) = dewey.flat_table(nodes, "id", "a[]", ["id", "v", "missing"]).collect()
    assert (r.id, r.node_path, r.parent_path, r.id_value, r.v, r.missing) == (1, "a[0]", "$", "x", "1", None)


def test_flat_table_has_all_members_and_holders(spark, monkeypatch):
    rows = [(1, json.dumps({"id": 7, "s": {"sum": 5, "t": [{"v": 1, "x": None}, {"w": [1, 2], "W": 3}]}}))]
    nodes = dewey.label_nodes(spark.createDataFrame(rows, "id long, j string"), "id", "j")
    df = dewey.flat_table(nodes, "id", "s.t[]", ["v"], found=True)
    assert df.columns == ["id", "node_path", "parent_path", "holder_path", "v", "W", "w_value", "x"]
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "s.t[0]", "$", "s", "1", None, None, None), (1, "s.t[1]", "$", "s", None, "3", "[1, 2]", None)]
    assert [tuple(r) for r in dewey.flat_table(nodes, "id", "$", [], found=True).collect()] == [(1, "$", None, None, "7")]
    assert [tuple(r) for r in dewey.other_objects(nodes, "id", ["$", "s.t[]"]).collect()] == [(1, "s", "$", "$", "s", "sum", "5")]
    monkeypatch.setattr(dewey, "MOST_COLUMNS", 1)
    df = dewey.flat_table(nodes, "id", "s.t[]", ["v"], found=True)
    assert {r.node_path: r.more_members for r in df.collect()} == {"s.t[0]": {"x": None}, "s.t[1]": {"w": "[1, 2]", "W": "3"}}


def test_scalars_among_objects_stay_at_their_position():
    root = {"styre": [{"r": 1}, "ubesatt", None], "poster": [{"b": 1}, None]}
    assert next(dewey.nodes_of(root, frozenset()))[3] == {"styre": '[null, "ubesatt", null]'}


def test_every_object_and_member_of_filings_is_in_a_table(spark, data):
    nodes = problems.filing_nodes(spark, data).select("rec_id", "schema_path", "fields", "steps").collect()
    links = {"rec_id", "node_path", "parent_path", "holder_path"}
    rows = members = 0
    for name in problems.FILING_TABLES:
        for r in problems.QUERIES[f"p1_{name}"](spark, data).collect():
            rows += 1
            members += sum(v is not None for k, v in r.asDict().items() if k not in links)
    others = problems.p1_others(spark, data).collect()
    rows += len({(r.rec_id, r.node_path) for r in others})
    members += sum(r.value is not None for r in others)
    assert rows == len(nodes) and members == sum(v is not None for n in nodes for v in n.fields.values())


def test_empty_repeated_and_deep(spark):
    assert found(dewey.label_nodes(spark.createDataFrame([], "id long, j string"), "id", "j")) == []
    twice = spark.createDataFrame([(1, '{"a": [{"b": 1}]}')] * 2, "id long, j string")
    assert found(dewey.label_nodes(twice, "id", "j")) == [(1, "a[0]", "$")] * 2
    deep = spark.createDataFrame([(1, '{"a":[' * 300 + "{}" + "]}" * 300), (2, "[" * 200_000)], "id long, j string")
    assert len(found(dewey.label_nodes(deep, "id", "j"))) == 300


@pytest.mark.parametrize("text", ["{", "nul", "\x00", '{"a": [}'])
def test_unreadable(text):
    assert dewey.read_json(text) is None


def deep(levels):
    return '{"a":[' * levels + "1" + "]}" * levels


def test_very_deep_records():
    """20,000 levels: nothing is lost."""
    root = dewey.read_json(deep(20_000))
    assert root is not None and dewey.array_names(root) == {"a"}
    n = 0
    for label, steps, _, _ in dewey.nodes_of(root, {"a"}):
        assert len(label) == len(steps) == n
        n += 1
    assert n == 20_000
    arrays = dewey.read_json('{"a":' + "[" * 20_000 + "7" + "]" * 20_000 + "}")
    fields = [f for _, _, path, f in dewey.nodes_of(arrays, set()) if path == "$"]
    assert fields[0]["a"].count("[") == 20_000


def test_deep_records_in_a_table(spark):
    df = spark.createDataFrame([(1, deep(1500)), (2, '{"a":[{"a":[{}]}]}')], "id int, j string")
    assert len(found(dewey.label_nodes(df, "id", "j"))) == 1499 + 2


@pytest.mark.parametrize("text", ['{"a": [1, 2.5e3, -0, true, null, "x\\n\\u00e5", {"b": {}}, []]}', "[]", "{}", ' [ {"q" : [ ] } ] ', '{"a": 1, "a": 2}', '["tab\there"]', "NaN", "-Infinity"])
def test_reader_without_recursion(text):
    a, b = dewey._read_deep(text), json.loads(text, strict=False)
    assert a == b or a != a and b != b
    assert dewey._dumps(b) == json.dumps(b, ensure_ascii=False)


@pytest.mark.parametrize("text", ["", "{", "[1,]", '{"a" 1}', '{"a":1,}', "[1] 2", "tru", '{1:2}', "[1 2]", '{"a":}', '"x', "]", "01"])
def test_reader_without_recursion_refuses(text):
    with pytest.raises(ValueError):
        json.loads(text)
    with pytest.raises((ValueError, IndexError)):
        dewey._read_deep(text)


def test_tables_are_cut_from_one_written_table(spark, data):
    one = problems.QUERIES["p1_notes"](spark, data)
    again = dewey.flat_table(problems.filing_nodes(spark, data), "rec_id", *problems.FILING_TABLES["notes"], found=True)
    assert one.columns == again.columns and sorted(map(str, one.collect())) == sorted(map(str, again.collect()))
    plan = one._jdf.queryExecution().toString()
    assert "path_bucket" in plan and "MapInPandas" not in plan
