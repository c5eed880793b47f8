"""Facts from tables, as annotations and as exchange documents (OP-N0 to N10, OP-X1 to X4)."""

from __future__ import annotations

from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import looks_numeric, short_number

#: Longest text that counts as a label.
MOST_LABEL = 80

#: Context addresses of the annotation format, and namespaces of the exchange format.
ANNOTATION_CONTEXT = "http://www.w3.org/ns/anno.jsonld"
FRAGMENTS = "http://www.w3.org/TR/media-frags/"
NAMESPACES = {
    "": "http://www.w3.org/1999/xhtml",
    "ix": "http://www.xbrl.org/2013/inlineXBRL",
    "xbrli": "http://www.xbrl.org/2003/instance",
    "iso4217": "http://www.xbrl.org/2003/iso4217",
    "link": "http://www.xbrl.org/2003/linkbase",
    "xlink": "http://www.w3.org/1999/xlink",
}


def text_labels(texts: DataFrame, text: str) -> DataFrame:
    """The texts that may be labels: not blank, no numbers, not too long (OP-N3)."""
    t = F.col(text)
    return texts.where(t.isNotNull() & (F.trim(t) != "") & ~looks_numeric(t) & (F.length(t) <= MOST_LABEL))


def table_rows(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, row_idx, cells``: the texts of each table row in column order (OP-N2)."""
    return cells.groupBy(*keys, "row_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("col_idx", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]).alias("cells"))


def row_facts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, row_idx, label, col_no, value_text``: the numeric cells of rows whose first cell is a label (OP-N4).

    Rows of one column and rows with a blank or too long label give none.
    """
    label = F.col("cells")[0]
    good = rows.where((F.size("cells") >= 2) & (F.trim(label) != "") & (F.length(label) <= MOST_LABEL))
    each = good.select(*keys, "row_idx", label.alias("label"), F.posexplode(F.slice("cells", 2, F.size("cells"))).alias("col_no", "value_text"))
    return each.where((F.trim("value_text") != "") & looks_numeric(F.col("value_text"))).withColumn("col_no", F.col("col_no") + 1)


def provenance(prov: Column) -> Column:
    """Page and box of a cell's first provenance; page 1 and an empty box by default (OP-N5)."""
    first = F.try_element_at(prov, F.lit(1))
    zero = lambda k: F.coalesce(first["bbox"][k], F.lit(0.0)).alias(k)
    return F.struct(F.coalesce(first["page_no"], F.lit(1)).alias("page_no"), F.struct(zero("l"), zero("t"), zero("r"), zero("b")).alias("bbox"))


def key_values(facts: DataFrame, doc: str, order: str) -> DataFrame:
    """Facts as key and value cells, 2i and 2i+1 in their document, with a link each (OP-N6)."""
    i = F.row_number().over(Window.partitionBy(doc).orderBy(order)) - 1
    return facts.select(doc, i.alias("link_no"), "concept_id", "value_text").select(
        doc, "link_no", (F.col("link_no") * 2).alias("key_cell"), F.col("concept_id").alias("key_text"), (F.col("link_no") * 2 + 1).alias("value_cell"), F.coalesce("value_text", F.lit("")).alias("value_text")
    )


def selectors(page: Column, bbox: Column, quote: Column) -> Column:
    """Page fragment, rectangle if there is a box, text quote if there is a text (OP-N7)."""
    none = F.lit(None).cast("string")
    one = lambda kind, value, conforms, exact: F.struct(F.lit(kind).alias("type"), value.alias("value"), conforms.alias("conformsTo"), exact.alias("exact"))
    rect = F.concat(
        F.lit("<svg xmlns='http://www.w3.org/2000/svg'><rect x='"), short_number(bbox["l"]), F.lit("' y='"), short_number(bbox["t"]), F.lit("' width='"), short_number(bbox["r"] - bbox["l"]), F.lit("' height='"), short_number(bbox["b"] - bbox["t"]), F.lit("'/></svg>")
    )
    return F.array_compact(
        F.array(
            one("FragmentSelector", F.concat(F.lit("page="), page.cast("string")), F.lit(FRAGMENTS), none),
            F.when(bbox.isNotNull(), one("SvgSelector", rect, none, none)),
            F.when(F.coalesce(quote, F.lit("")) != "", one("TextQuoteSelector", none, none, quote)),
        )
    )


def vote_confidence(hit: Column, total: Column, dropped: Column) -> Column:
    """The vote behind a fact; null unless both the voters and their number are known (part of OP-N8)."""
    n = F.size(hit)
    text = F.when(n == total, F.lit("unanimous")).otherwise(F.concat_ws("/", n.cast("string"), total.cast("string")))
    return F.when(hit.isNotNull() & total.isNotNull(), F.struct(n.alias("voters"), total.alias("of"), text.alias("text"), hit.alias("voters_hit"), dropped.alias("column_dropped_voters")))


def annotations(facts: DataFrame, concepts: DataFrame, creator: str = "urn:ledgerloom:pipeline", language: str = "no") -> DataFrame:
    """``fact_id, annotation``: facts as annotation structs, with what the vocabulary tells of the concept (OP-N8).

    ``facts``: fact_id, source, page_no, bbox, concept_id, value_text, voters_hit, voters_total,
    dropped, period_start, period_end, dimensions. The id is a digest of the fact's key, the same on
    every run (OP-N10 draws one).
    """
    known = concepts.select("concept_id", "period_type", "balance")
    f = facts.join(known, "concept_id", "left")
    none = F.lit(None).cast("string")
    part = lambda kind, purpose, source, value, form, lang: F.struct(F.lit(kind).alias("type"), F.lit(purpose).alias("purpose"), source.alias("source"), value.alias("value"), form.alias("format"), lang.alias("language"))
    return f.select(
        "fact_id",
        F.struct(
            F.concat(F.lit("urn:ledgerloom:annotation:"), F.substring(F.sha2(F.concat_ws("|", F.col("fact_id").cast("string"), "source", "concept_id"), 256), 1, 32)).alias("id"),
            F.lit("Annotation").alias("type"),
            F.lit("tagging").alias("motivation"),
            F.struct(F.lit(creator).alias("id"), F.lit("Software").alias("type")).alias("creator"),
            F.struct(F.col("source"), selectors(F.col("page_no"), F.col("bbox"), F.col("value_text")).alias("selector")).alias("target"),
            F.array(part("SpecificResource", "classifying", F.col("concept_id"), none, none, none), part("TextualBody", "tagging", none, F.col("value_text"), F.lit("text/plain"), F.lit(language))).alias("body"),
            vote_confidence(F.col("voters_hit"), F.col("voters_total"), F.col("dropped")).alias("registrum:cascadeConfidence"),
            F.col("period_type").alias("registrum:periodType"),
            F.col("balance").alias("registrum:balance"),
            F.col("period_start").alias("registrum:periodStart"),
            F.col("period_end").alias("registrum:periodEnd"),
            F.col("dimensions").alias("registrum:dimensions"),
        ).alias("annotation"),
    )


def annotation_json(annotated: DataFrame) -> DataFrame:
    """``fact_id, json``: one object a fact, its context first, absent members left out (OP-N9)."""
    return annotated.select("fact_id", F.to_json(F.struct(F.array(F.lit(ANNOTATION_CONTEXT)).alias("@context"), "annotation.*")).alias("json"))


def annotation_pages(annotated: DataFrame, key: str, label: str = "facts") -> DataFrame:
    """Per key a collection with its total and one page of all annotations (OP-N9)."""
    by_id = lambda a, b: F.when(a["fact_id"] < b["fact_id"], -1).when(a["fact_id"] > b["fact_id"], 1).otherwise(0)  # noqa: E731 maps have no order
    listed = annotated.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("fact_id", "annotation")), by_id).alias("all"))
    return listed.select(
        key,
        F.to_json(
            F.struct(
                F.array(F.lit(ANNOTATION_CONTEXT)).alias("@context"),
                F.concat(F.lit("urn:ledgerloom:collection:"), F.col(key).cast("string")).alias("id"),
                F.lit("AnnotationCollection").alias("type"),
                F.lit(label).alias("label"),
                F.size("all").alias("total"),
                F.struct(F.lit("AnnotationPage").alias("type"), F.transform("all", lambda x: x["annotation"]).alias("items")).alias("first"),
            )
        ).alias("json"),
    )


# exchange documents ----------------------------------------------------


def exchange_facts(facts: DataFrame, concepts: DataFrame, period_start: Column, currency: str = "NOK", keep: tuple[str, ...] = ()) -> DataFrame:
    """Facts with context, unit, number text and sign of the exchange format (OP-X2 to X4).

    ``facts``: fact_id, concept_id, value_num, value_text, period_end, decimals, unit, period_type.
    Period type and unit come from the fact, else from the vocabulary, else duration and the
    currency. A concept without a prefix is an error. Columns in ``keep`` are carried along.
    """
    known = concepts.select("concept_id", F.col("period_type").alias("__pt"), F.lower("data_type").alias("__dt"))
    f = facts.join(known, "concept_id", "left").where(F.when(~F.contains("concept_id", F.lit(":")), F.raise_error(F.concat(F.lit("concept without prefix: "), "concept_id")).cast("boolean")).otherwise(True))
    kind = F.coalesce("period_type", "__pt", F.lit("duration"))
    dt = F.coalesce("__dt", F.lit(""))
    unit = F.coalesce("unit", F.when(F.contains(dt, F.lit("monetary")), F.lit(currency)).when(F.contains(dt, F.lit("shares")), F.lit("shares")).when(dt.rlike("decimal|pure|percent"), F.lit("pure")).otherwise(F.lit(currency)))
    text_number = F.col("value_text").rlike(r"^\s*-?\d+(\.\d+)?\s*$")
    out = f.withColumn("trunc_num", F.when(F.col("value_num") < 0, F.ceil("value_num")).otherwise(F.floor("value_num")))
    is_text = F.col("value_num").isNull() & ~F.coalesce(text_number, F.lit(False))
    start = period_start
    return out.select(
        *keep,
        "fact_id",
        "concept_id",
        F.split_part("concept_id", F.lit(":"), F.lit(1)).alias("prefix"),
        kind.alias("period_type"),
        start.alias("period_start"),
        "period_end",
        F.replace(F.when(kind == "instant", F.concat(F.lit("ctx_instant_"), F.coalesce("period_end", F.lit("")))).otherwise(F.concat(F.lit("ctx_duration_"), F.coalesce(start, F.lit("")), F.lit("_"), F.coalesce("period_end", F.lit("")))), F.lit("-"), F.lit("")).alias("context_id"),
        unit.alias("unit"),
        F.concat(F.lit("unit_"), F.lower(unit)).alias("unit_id"),
        F.when(is_text, F.lit("nonNumeric")).otherwise(F.lit("nonFraction")).alias("element"),
        F.when(F.col("value_num").isNotNull(), F.abs(F.col("trunc_num")).cast("string")).otherwise(F.coalesce("value_text", F.lit(""))).alias("shown"),
        F.when(F.col("value_num") < 0, F.lit("-")).otherwise(F.lit("")).alias("sign"),
        F.coalesce("decimals", F.lit(0)).alias("decimals"),
    )


def contexts(exchanged: DataFrame) -> DataFrame:
    """The distinct contexts of exchange facts (part of OP-X1)."""
    return exchanged.groupBy("context_id").agg(F.min("period_type").alias("period_type"), F.min("period_start").alias("period_start"), F.min("period_end").alias("period_end"), F.count("*").alias("n_facts"))


def exchange_documents(exchanged: DataFrame, entity: str, schema_ref: str) -> DataFrame:
    """``entity, document``: one exchange document (inline XBRL in XHTML) per entity (OP-X1).

    ``exchanged`` has the entity's number as column ``entity``. Contexts and units stand once, in the
    order in which facts use them; text facts have no unit. A filing is a bounded group.
    """
    columns = ["fact_id", "concept_id", "period_type", "period_start", "period_end", "context_id", "unit", "unit_id", "element", "shown", "sign", "decimals"]
    names = " ".join(f'xmlns{":" + k if k else ""}="{v}"' for k, v in NAMESPACES.items())

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fact_id")
        who = str(pdf[entity].iloc[0])
        t = lambda v: escape("" if v is None or v != v else str(v))
        seen, unit_names, lines = {}, {}, []
        for r in pdf.itertuples():
            seen.setdefault(r.context_id, r)
            unit_names.setdefault(r.unit_id, r.unit)
            about = f"name={quoteattr(r.concept_id)} contextRef={quoteattr(r.context_id)}"
            if r.element == "nonFraction":
                about += f' unitRef={quoteattr(r.unit_id)} decimals="{int(r.decimals)}"' + (' sign="-"' if r.sign else "")
            lines.append(f"<p><ix:{r.element} {about}>{t(r.shown)}</ix:{r.element}></p>")
        periods = []
        for k, r in seen.items():
            when = f"<xbrli:instant>{t(r.period_end)}</xbrli:instant>" if r.period_type == "instant" else f"<xbrli:startDate>{t(r.period_start)}</xbrli:startDate><xbrli:endDate>{t(r.period_end)}</xbrli:endDate>"
            periods.append(f'<xbrli:context id={quoteattr(k)}><xbrli:entity><xbrli:identifier scheme="https://www.brreg.no/">{t(who)}</xbrli:identifier></xbrli:entity><xbrli:period>{when}</xbrli:period></xbrli:context>')
        measures = [f'<xbrli:unit id={quoteattr(k)}><xbrli:measure>{"iso4217" if v == "NOK" else "xbrli"}:{t(v)}</xbrli:measure></xbrli:unit>' for k, v in unit_names.items()]
        last = max((x for x in pdf["period_end"] if x), default="")
        doc = (
            f"<?xml version='1.0' encoding='utf-8'?>\n<html {names}><head><title>{t(who)} {t(last)}</title></head><body><ix:header><ix:references>"
            f'<link:schemaRef xlink:type="simple" xlink:href={quoteattr(schema_ref)}/></ix:references><ix:resources>{"".join(periods)}{"".join(measures)}</ix:resources></ix:header><div><h1>{t(last)}</h1>{"".join(lines)}</div></body></html>'
        )
        return pd.DataFrame({"entity": [who], "document": [doc]})

    return exchanged.select(entity, *columns).groupBy(entity).applyInPandas(build, "entity string, document string")


# the whole path --------------------------------------------------------


def enrich(cells: DataFrame, resolved: DataFrame, keys: list[str], period_end: Column) -> DataFrame:
    """Facts of all tables whose label has a concept (table half of OP-N0).

    ``resolved``: label, concept_id, one row per label. All columns of a row get the same period.
    """
    found = row_facts(table_rows(cells, keys), keys)
    return found.join(resolved.where(F.col("concept_id").isNotNull()).select("label", "concept_id"), "label").withColumn("period_end", period_end)


def label_counts(texts: DataFrame, text: str, resolved: DataFrame) -> DataFrame:
    """One row: labels seen and labels with a concept (the counters of OP-N0)."""
    seen = text_labels(texts, text).select(F.col(text).alias("label"))
    hit = seen.join(resolved.select("label", "concept_id"), "label", "left")
    return hit.agg(F.count("*").alias("n_labels_seen"), F.count("concept_id").alias("n_labels_resolved"))
