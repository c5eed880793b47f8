"""Schemas made from the vocabulary, and facts from what fills them (OP-G1 to G6)."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field_name(concept_id: str) -> str:
    """A concept's name as a field name (OP-G1)."""
    return re.sub(r"(?<=[^A-ZÆØÅ])([A-ZÆØÅ])", r"_\1", concept_id.split(":", 1)[-1]).lower()


def arc_schema(arcs: list[tuple[str, float, int]], parent: str) -> T.StructType:
    """One nullable number per child and one for the total (OP-G2); ``arcs``: child, weight, order.

    Fields know their concept in the metadata. Children of one name get their order added. No child
    is an error.
    """
    if not arcs:
        raise ValueError(f"{parent} has no children")
    fields: dict[str, T.StructField] = {}
    for child, weight, order in sorted(arcs, key=lambda a: (a[2], a[0])):
        name = field_name(child)
        name = f"{name}_{order}" if name in fields else name
        fields[name] = T.StructField(name, T.DoubleType(), True, {"concept_id": child, "weight": weight})
    fields["sum_total"] = T.StructField("sum_total", T.DoubleType(), True, {"concept_id": parent})
    return T.StructType(list(fields.values()))


def axis_schema(members: list[str], axis: str) -> T.StructType:
    """One nullable number per member, the suffix of member names left out (OP-G3)."""
    if not members:
        raise ValueError(f"{axis} has no members")
    return T.StructType([T.StructField(re.sub("_member$", "", field_name(m)), T.DoubleType(), True, {"concept_id": m}) for m in members])


def cube_schema(concepts: list[str], rows: list[str], columns: list[str]) -> T.StructType:
    """A map of maps of numbers per concept (OP-G4); both axes need members."""
    if not rows or not columns:
        raise ValueError("both axes need members")
    cell = T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType()))
    return T.StructType([T.StructField(field_name(c), cell, True, {"concept_id": c}) for c in concepts])


def facts_of_fields(df: DataFrame, keys: list[str], schema: T.StructType) -> DataFrame:
    """``keys, concept_id, value``: the fields that have a value, the total left out (OP-G5)."""
    pairs = [F.struct(F.lit(f.metadata.get("concept_id") or f.name).alias("concept_id"), F.col(f.name).cast("double").alias("value")) for f in schema.fields if f.name != "sum_total"]
    return df.select(*keys, F.explode(F.array(*pairs)).alias("x")).where(F.col("x.value").isNotNull()).select(*keys, "x.concept_id", "x.value")


def facts_of_cube(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``keys, row_member, col_member, value`` of a map of maps."""
    outer = df.select(*keys, F.explode(column).alias("row_member", "__m"))
    return outer.select(*keys, "row_member", F.explode("__m").alias("col_member", "value")).where(F.col("value").isNotNull())


def build_prompt(text: str, parent: str, schema: T.StructType) -> str:
    """What an extraction client is asked (part of OP-G6)."""
    lines = "\n".join(f"- {f.name}: {f.metadata.get('concept_id', f.name)}" for f in schema.fields)
    return f"Read the amounts below {parent} from the text. Leave out what it does not state.\nFields:\n{lines}\n\nText:\n{text}"


def extract(df: DataFrame, keys: list[str], text: str, parent: str, schema: T.StructType, client: Callable[[str, dict], dict]) -> DataFrame:
    """``keys, concept_id, value``: what a client given as a Python callable reads from texts (OP-G6).

    ``client(prompt, json_schema)`` returns a dict or JSON text; unknown fields and what is no number
    are left out.
    """
    shape = {"type": "object", "properties": {f.name: {"type": ["number", "null"]} for f in schema.fields}}

    def run(batches):
        for pdf in batches:
            out = []
            for t in pdf[text]:
                got = client(build_prompt("" if t is None else t, parent, schema), shape)
                got = json.loads(got) if isinstance(got, str) else (got or {})
                out.append(json.dumps({f.name: got.get(f.name) for f in schema.fields if isinstance(got.get(f.name), (int, float))}))
            yield pdf[keys].assign(json=out)

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    parsed = df.select(*keys, text).mapInPandas(run, f"{kinds}, json string").select(*keys, F.from_json("json", T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])).alias("s")).select(*keys, "s.*")
    return facts_of_fields(parsed, keys, schema)
