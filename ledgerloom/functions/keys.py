"""Key fields in one spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def org_number(c: Column) -> Column:
    """Nine digits without country letters, tax suffix, points or blanks; other texts trimmed."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(digits) == 9, digits).otherwise(F.trim(c))


def concept_key(c: Column, prefix: str = "regnskap-no") -> Column:
    """``prefix:Name`` from a name with a web address, another case, ``_`` or blanks around the colon."""
    name = F.regexp_extract(c, rf"(?i)^\s*(?:https?://\S*[#/])?\s*(?:{prefix}\s*[:_#]\s*)?([^\s:#/]+)\s*$", 1)
    return F.when(name != "", F.concat(F.lit(prefix + ":"), name)).otherwise(F.trim(c))


def iso_day(c: Column) -> Column:
    """``YYYY-MM-DD`` from that, ``D.M.YYYY``, ``YYYYMMDD`` or a time stamp; other texts trimmed."""
    t = F.trim(c)
    dotted = F.concat_ws(
        "-",
        F.regexp_extract(t, r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", 3),
        F.lpad(F.regexp_extract(t, r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", 2), 2, "0"),
        F.lpad(F.regexp_extract(t, r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", 1), 2, "0"),
    )
    return (
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.substring(t, 1, 10))
        .when(t.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)))
        .when(t.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), dotted)
        .otherwise(t)
    )
