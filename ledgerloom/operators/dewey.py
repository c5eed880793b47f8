"""Nested records to related flat tables by Dewey labels (problem 1).

Every JSON object of a record becomes one row. Its Dewey label is the list of ordinals on the way
from the root: one component per member step, the member's ordinal and, where arrays are entered,
the positions in them (``"4-0"``: first element of the fifth member). The labels alone carry the
hierarchy: the parent of an object is found by cutting its label, without a join, and the objects
of one schema path form one table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from json.decoder import scanstring

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names whose arrays of objects make a lone object an element are kept in the plan up to this many.
#: They are schema names and so do not grow with the rows; beyond it they are joined per record.
NAMES_IN_PLAN = 5_000
#: A flat table gets a column for each member found up to this many; beyond it the further ones share a map.
MOST_COLUMNS = 1_000

#: Parts of labels that a batch of objects holds about.
BATCH_PARTS = 400_000
#: Partitions of a written table of objects, by a hash of their schema path.
PATH_BUCKETS = 32

NODE = T.StructType(
    [
        T.StructField("dewey", T.ArrayType(T.StringType())),
        T.StructField("steps", T.ArrayType(T.StringType())),
        T.StructField("schema_path", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)


_BLANK = re.compile(r"[ \t\r\n]*")
_SCALAR = re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?|true|false|null|NaN|-?Infinity")


def _read_deep(text: str):
    """What ``json.loads`` gives, with a stack of its own: for records nested deeper than the interpreter recurses."""
    root, stack, names, state, i = None, [], [], "value", 0

    def put(v) -> None:
        nonlocal root
        if not stack:
            root = v
        elif isinstance(stack[-1], list):
            stack[-1].append(v)
        else:
            stack[-1][names[-1]] = v

    while True:
        i = _BLANK.match(text, i).end()
        c = text[i : i + 1]
        if state == "after":
            if not stack:
                if c:
                    raise ValueError("text after the value")
                return root
            inside = isinstance(stack[-1], dict)
            if c == ",":
                state, i = "name" if inside else "value", i + 1
            elif c == ("}" if inside else "]"):
                stack.pop()
                names.pop()
                i += 1
            else:
                raise ValueError("neither a comma nor an end")
        elif c == {"first name": "}", "first value": "]"}.get(state):
            stack.pop()
            names.pop()
            state, i = "after", i + 1
        elif state in ("name", "first name"):
            if c != '"':
                raise ValueError("no name")
            names[-1], i = scanstring(text, i + 1, False)
            i = _BLANK.match(text, i).end()
            if text[i : i + 1] != ":":
                raise ValueError("no colon")
            state, i = "value", i + 1
        elif c and c in "{[":
            v: dict | list = {} if c == "{" else []
            put(v)
            stack.append(v)
            names.append(None)
            state, i = "first name" if c == "{" else "first value", i + 1
        elif c == '"':
            v, i = scanstring(text, i + 1, False)
            put(v)
            state = "after"
        elif m := _SCALAR.match(text, i):
            put(json.loads(m[0]))
            state, i = "after", m.end()
        else:
            raise ValueError("no value")


def _loads(text: str):
    try:
        return json.loads(text, strict=False)
    except RecursionError:
        return _read_deep(text)


def _dumps(value) -> str:
    """``json.dumps`` for values nested as deep as may be."""
    try:
        return json.dumps(value, ensure_ascii=False)
    except RecursionError:
        pass
    out, todo = [], [value]
    while todo:
        v = todo.pop()
        if isinstance(v, _Written):
            out.append(v)
        elif isinstance(v, dict):
            inner = [x for i, (k, y) in enumerate(v.items()) for x in (_Written((", " if i else "") + json.dumps(k, ensure_ascii=False) + ": "), y)]
            todo += reversed([_Written("{"), *inner, _Written("}")])
        elif isinstance(v, list):
            inner = [x for i, y in enumerate(v) for x in (_Written(", " if i else ""), y)]
            todo += reversed([_Written("["), *inner, _Written("]")])
        else:
            out.append(json.dumps(v, ensure_ascii=False))
    return "".join(out)


class _Written(str):
    """A piece of finished JSON."""


def _held(value):
    """What a value holds: text that is a JSON object or array, however often quoted, counts as that."""
    while isinstance(value, str):
        head = value.lstrip("﻿ \t\r\n")[:1]
        if head not in ("{", "[", '"'):
            return value
        try:
            inner = _loads(value.strip("﻿ \t\r\n"))
        except ValueError:
            return value
        if isinstance(inner, str) and head != '"':
            return value
        if not isinstance(inner, (dict, list, str)):
            return value
        value = inner
    return value


def read_json(text) -> dict | list | None:
    """The object or array of a text; None where it cannot be read or is a scalar."""
    value = _held(text) if isinstance(text, str) else None
    return value if isinstance(value, (dict, list)) else None


def array_names(root) -> set[str]:
    """Member names under which ``root`` has arrays with objects in them."""
    found: set[str] = set()
    todo = [("", root)]
    while todo:
        name, value = todo.pop()
        value = _held(value)
        if isinstance(value, dict):
            todo.extend(value.items())
        elif isinstance(value, list):
            for x in value:
                x = _held(x)
                if isinstance(x, dict):
                    found.add(name)
                if isinstance(x, (dict, list)):
                    todo.append((name, x))
    return found


def _text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return _dumps(value)


def nodes_of(root, lone: frozenset[str] | set[str]) -> Iterator[tuple[list[str], list[str], str, dict]]:
    """(dewey, steps, schema path, scalar members) of every object in ``root``, in document order."""
    todo = [([], [], [], "", root)]
    while todo:
        dewey, steps, schema, name, value = todo.pop()
        below = []
        if isinstance(value, dict):
            fields = {}
            for i, (k, v) in enumerate(value.items()):
                v = _held(v)
                if isinstance(v, dict) and k in lone:
                    v = [v]
                if isinstance(v, (dict, list)):
                    below.append(([*dewey, str(i)], [*steps, k], [*schema, k], k, v))
                if isinstance(v, list) and any(isinstance(_held(x), dict) for x in v):
                    # scalars among objects, each at its position
                    scalars = [None if isinstance(_held(x), (dict, list)) else x for x in v]
                    if any(x is not None for x in scalars):
                        fields[k] = _text(scalars)
                elif not isinstance(v, dict):
                    fields[k] = _text(v)
            yield dewey, steps, ".".join(schema) or "$", fields
        else:
            base = dewey or ["0"], steps or [""], schema or [""]
            for i, v in enumerate(value):
                v = _held(v)
                if isinstance(v, (dict, list)):
                    below.append(([*base[0][:-1], f"{base[0][-1]}-{i}"], [*base[1][:-1], f"{base[1][-1]}[{i}]"], [*base[2][:-1], base[2][-1] + "[]"], name, v))
        todo.extend(reversed(below))


def schema_array_names(df: DataFrame, text: str) -> DataFrame:
    """One row per member name that has an array of objects anywhere in ``df`` (column ``name``)."""

    def run(batches):
        for pdf in batches:
            names: set[str] = set()
            for t in pdf[text]:
                if (root := read_json(t)) is not None:
                    names |= array_names(root)
            yield pd.DataFrame({"name": sorted(names)}, dtype=object)

    return df.select(text).mapInPandas(run, "name string").distinct()


def label_nodes(df: DataFrame, key: str, text: str, names: set[str] | None = None) -> DataFrame:
    """All objects of the nested texts: ``key, dewey, steps, schema_path, fields, is_element``.

    A lone object under a name that elsewhere has arrays of objects is labelled as element 0.
    ``names`` are those names; None finds them over the whole input. Null and unreadable texts and
    bare scalars give no rows, records of any depth give all theirs; equal keys are labelled on their own; an empty input gives no rows.
    """
    source = df.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    joined = None
    if names is None:
        found = schema_array_names(source, "__text")
        rows = found.limit(NAMES_IN_PLAN + 1).collect()
        if len(rows) <= NAMES_IN_PLAN:
            names = {r.name for r in rows}
        else:
            joined = found
    if joined is not None:
        # so many names that they are data: each record gets only those of its own
        def own(batches):
            for pdf in batches:
                out = [(k, n) for k, t in zip(pdf["__row"], pdf["__text"]) if (r := read_json(t)) is not None for n in _member_names(r)]
                yield pd.DataFrame(out, columns=["__row", "name"])

        source = source.withColumn("__row", F.xxhash64("__text"))
        per_text = source.select("__row", "__text").mapInPandas(own, "__row long, name string").distinct().join(joined, "name").groupBy("__row").agg(F.collect_set("name").alias("__names"))
        source = source.join(per_text, "__row", "left").drop("__row")
    fixed = frozenset(names or ())
    key_type = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, key_type), *NODE.fields])

    def run(batches):
        for pdf in batches:
            out, parts = [], 0
            for i, (k, t) in enumerate(zip(pdf["__key"], pdf["__text"])):
                if (root := read_json(t)) is None:
                    continue
                lone = fixed
                if "__names" in pdf:
                    own_names = pdf["__names"].iloc[i]
                    lone = frozenset(own_names) if own_names is not None else frozenset()
                for n in nodes_of(root, lone):
                    out.append((k, *n))
                    parts += 8 + len(n[0])
                    if parts >= BATCH_PARTS:  # labels of very deep records are long
                        yield pd.DataFrame(out, columns=schema.names)
                        out, parts = [], 0
            yield pd.DataFrame(out, columns=schema.names)

    return source.mapInPandas(run, schema).withColumn("is_element", F.coalesce(F.try_element_at("dewey", F.lit(-1)).contains("-"), F.lit(False)))


def _member_names(root) -> set[str]:
    names, todo = set(), [root]
    while todo:
        v = _held(todo.pop())
        if isinstance(v, dict):
            names.update(v)
            todo.extend(v.values())
        elif isinstance(v, list):
            todo.extend(v)
    return names


def parent_depth(dewey: Column) -> Column:
    """Length to which a label is cut to give the nearest array element around; 0 is the root."""
    above = F.slice(dewey, 1, F.greatest(F.size(dewey) - 1, F.lit(0)))
    return F.coalesce(F.array_max(F.transform(above, lambda c, i: F.when(c.contains("-"), i + 1).otherwise(0))), F.lit(0))


def path_of(steps: Column, depth: Column) -> Column:
    """The path of the first ``depth`` steps; ``$`` for none."""
    return F.when(depth > 0, F.array_join(F.slice(steps, 1, depth), ".")).otherwise(F.lit("$"))


def element_links(nodes: DataFrame, key: str) -> DataFrame:
    """``key, node_path, parent_path`` of every object that is an array element."""
    return nodes.where("is_element").select(
        key, F.array_join("steps", ".").alias("node_path"), path_of(F.col("steps"), parent_depth(F.col("dewey"))).alias("parent_path")
    )


def holder_path(steps: Column) -> Column:
    """The path of the object that directly holds one, array element or not; null for the root."""
    return F.when(F.size(steps) > 0, path_of(steps, F.size(steps) - 1))


def _links(key: str) -> list:
    """The link columns of flat tables; the root has neither parent nor holder."""
    steps = F.col("steps")
    return [
        key,
        path_of(steps, F.size(steps)).alias("node_path"),
        F.when(F.size(steps) > 0, path_of(steps, parent_depth(F.col("dewey")))).alias("parent_path"),
        holder_path(steps).alias("holder_path"),
    ]


def in_buckets(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``path_bucket``, by which a written table of them is partitioned."""
    return nodes.withColumn("path_bucket", F.pmod(F.xxhash64("schema_path"), F.lit(PATH_BUCKETS)).cast("int"))


def of_path(nodes: DataFrame, schema_path: str) -> DataFrame:
    """The objects of one schema path; of a table written in buckets only that path's bucket is read."""
    one = nodes.where(F.col("schema_path") == schema_path)
    return one.where(F.col("path_bucket") == F.pmod(F.xxhash64(F.lit(schema_path)), F.lit(PATH_BUCKETS)).cast("int")) if "path_bucket" in nodes.columns else one


def flat_table(nodes: DataFrame, key: str, schema_path: str, columns: list[str], found: bool = False) -> DataFrame:
    """The objects of one schema path as a flat table with links to their record, parent and holder.

    ``columns`` are the scalar members wanted, as text; absent members are null. With ``found`` every
    further member that an object of the path has anywhere in the input follows by name, which takes
    one more pass; more than ``MOST_COLUMNS`` of them share the map ``more_members``. The link columns
    are ``key, node_path, parent_path, holder_path``: the parent is the nearest array element around,
    the holder the object directly around, ``$`` the root. A member whose name is taken, in any case
    of letters, is suffixed ``_value``.
    """
    rows = of_path(nodes, schema_path)
    more = []
    if found:
        names = rows.select(F.explode(F.map_keys("fields")).alias("name")).where(~F.col("name").isin(columns)).distinct()
        more = sorted(r.name for r in names.limit(MOST_COLUMNS + 1).collect())
    taken = {x.lower() for x in (key, "node_path", "parent_path", "holder_path")}

    def free(name: str) -> str:
        while name.lower() in taken:
            name += "_value"
        taken.add(name.lower())
        return name

    if len(more) > MOST_COLUMNS:
        wanted = F.array(*[F.lit(c) for c in columns]).cast("array<string>")
        last = [F.map_filter("fields", lambda k, _: ~F.array_contains(wanted, k)).alias("more_members")]
        taken.add("more_members")
        more = []
    else:
        last = []
    return rows.select(*_links(key), *[F.col("fields")[c].alias(free(c)) for c in [*columns, *more]], *last)


def other_objects(nodes: DataFrame, key: str, schema_paths: list[str]) -> DataFrame:
    """``key, node_path, parent_path, holder_path, schema_path, member, value``: the objects of all other schema paths.

    One row per scalar member, so that kinds of object nobody foresaw are carried whole; an object
    without scalar members has one row with null ``member``.
    """
    rest = nodes.where(~F.col("schema_path").isin(schema_paths))
    return rest.select(*_links(key), "schema_path", F.explode_outer("fields").alias("member", "value"))
