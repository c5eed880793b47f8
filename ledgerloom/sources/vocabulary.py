"""Vocabularies from Turtle and XML Schema (OP-S9, OP-S10) and from parquet (OP-S1)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""\s+|\#[^\n]*|(?P<uri><[^>]*>)|(?P<text>\"\"\"(?:[^\\]|\\.)*?\"\"\"|"(?:[^"\\]|\\.)*")(?:@(?P<lang>[A-Za-z-]+)|\^\^(?:<[^>]*>|[\w-]*:[\w.-]*))?|(?P<at>@\w+|PREFIX\b|BASE\b)|(?P<mark>[;,.\[\]()])|(?P<name>[^\s;,\[\]()"<>]+?(?=[\s;,\[\]()<>"]|\.(?:\s|$)|$))""",
    re.DOTALL,
)


def read_turtle(text: str) -> list[tuple[str, str, str, str | None]]:
    """(subject, predicate, object, language) of a Turtle text; blank nodes get numbers.

    Names stay as they are written, addresses keep their brackets, texts lose their quotes. Meant for
    vocabularies of a few thousand statements; it runs on the driver.
    """
    tokens = []
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if m["text"] is not None:
            q = 3 if m["text"].startswith('"""') else 1
            body = m["text"][q:-q].replace('\\"', '"').replace("\\n", "\n").replace("\\t", "\t").replace("\\\\", "\\")
            tokens.append(("text", body, m["lang"]))
        elif kind in ("uri", "at", "mark", "name"):
            tokens.append((kind, m[0], None))
    out, at, blanks = [], 0, 0

    def node():
        nonlocal at, blanks
        kind, value, lang = tokens[at]
        at += 1
        if kind == "mark" and value in "[(":
            blanks += 1
            me = f"_:{blanks}"
            if value == "[":
                statements(me, "]")
            else:
                items = []
                while tokens[at][1] != ")" or tokens[at][0] != "mark":
                    items.append(node())
                for n, (v, g) in enumerate(items):
                    out.append((me, f"item {n}", v, g))
            at += 1
            return me, None
        return ("a" if (kind, value) == ("name", "a") else value), lang

    def statements(subject: str, end: str):
        nonlocal at
        while at < len(tokens) and not (tokens[at][0] == "mark" and tokens[at][1] == end):
            if tokens[at][:2] == ("mark", ";"):
                at += 1
                continue
            predicate, _ = node()
            while True:
                value, lang = node()
                out.append((subject, predicate, value, lang))
                if at < len(tokens) and tokens[at][:2] == ("mark", ","):
                    at += 1
                    continue
                break

    while at < len(tokens):
        kind, value, _ = tokens[at]
        if kind == "at":
            while tokens[at][:2] != ("mark", ".") and not (kind == "at" and tokens[at][0] == "uri" and value.isupper()):
                at += 1
            at += 1
            continue
        subject, _ = node()
        statements(subject, ".")
        at += 1
    return out


def turtle_tables(spark: SparkSession, text: str) -> dict[str, DataFrame]:
    """Concepts, axes, axis members, labels, mappings and broader arcs of a vocabulary.

    The text has no weights: arcs from ``skos:broader`` weigh 1 and are marked ``weight_assumed``.
    """
    triples = spark.createDataFrame(read_turtle(text) or [(None, None, None, None)], "s string, p string, o string, lang string").where("s is not null")
    kinds = triples.where(F.col("p") == "a").groupBy("s").agg(F.collect_set("o").alias("kinds"))
    local = F.regexp_extract("p", r"([^:#/>]+)>?$", 1)
    wanted = ["periodType", "balance", "dataType", "status", "abstract", "introducedVersion", "memberOf", "axisKind"]
    attributes = triples.withColumn("p2", local).where(F.col("p2").isin(*wanted)).groupBy("s").pivot("p2", wanted).agg(F.first("o"))
    all_of = kinds.join(attributes, "s", "left")
    is_kind = lambda k: F.exists("kinds", lambda x: x.endswith(k))
    member, axis = is_kind(":Member"), is_kind("Axis")
    named = F.col("s").alias("concept_id")
    return {
        "concepts": all_of.where(F.col("periodType").isNotNull()).select(named, F.col("periodType").alias("period_type"), "balance", F.col("dataType").alias("data_type"), (F.col("abstract") == "true").alias("abstract"), "status", F.col("introducedVersion").alias("introduced_version")),
        "axes": all_of.where(axis).select(F.col("s").alias("axis_id"), F.col("axisKind").alias("axis_kind"), "status"),
        "members": all_of.where(member).select(F.col("memberOf").alias("axis_id"), F.col("s").alias("member_id"), F.lit(0).alias("order")),
        "labels": triples.where(F.col("p").endswith("prefLabel") | F.col("p").endswith("altLabel")).join(all_of.select("s", member.alias("m"), axis.alias("x")), "s").select(
            F.col("s").alias("subject_id"), F.when(F.col("m"), "member").when(F.col("x"), "axis").otherwise("concept").alias("subject_kind"), "lang", F.when(F.col("p").endswith("prefLabel"), "standardLabel").otherwise("altLabel").alias("role"), F.col("o").alias("text")
        ),
        "mappings": triples.where(F.col("p").rlike("(exact|close|broad|narrow|related)Match$")).select(F.col("s").alias("subject_id"), F.col("o").alias("target"), F.regexp_extract("p", r"([a-z]+Match)$", 1).alias("relation")),
        "arcs": triples.where(F.col("p").endswith("broader")).select(F.lit("broader").alias("role"), F.col("o").alias("parent_id"), F.col("s").alias("child_id"), F.lit(1.0).alias("weight"), F.lit(0).alias("order"), F.lit(True).alias("weight_assumed")),
    }


def schema_elements(spark: SparkSession, path: str) -> DataFrame:
    """``name, type, period_type, balance`` of the elements of an XML Schema (OP-S10)."""
    df = spark.read.format("xml").option("rowTag", "xs:element").load(path)
    at = lambda c: F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string")
    return df.select(at("_name").alias("name"), at("_type").alias("type"), at("_xbrli:periodType").alias("period_type"), at("_xbrli:balance").alias("balance"))
