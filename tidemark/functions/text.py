"""Normalisers of text columns; each maps a Column to a Column and stays in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the sources may say for true and false.
TRUE_WORDS, FALSE_WORDS = ("true", "y", "1", "yes"), ("false", "n", "0", "no")
EMAIL = r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"


def trimmed(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


def canonical(c: Column, allowed: Iterable[str] | Mapping[str, str]) -> Column:
    """The allowed value that equals c but for case and outer white space, else null. A mapping gives lower-case keys."""
    pairs = allowed.items() if isinstance(allowed, Mapping) else ((a.lower(), a) for a in allowed)
    table = F.create_map(*[F.lit(x) for pair in sorted(pairs) for x in pair])
    return F.try_element_at(table, F.lower(trimmed(c)))


def phone(c: Column) -> Column:
    """+91- and ten digits, or null: behind a +91, or twelve digits that begin with 91, or ten digits."""
    v = trimmed(c)
    digits = F.regexp_replace(v, "[^0-9]", "")
    behind = F.regexp_replace(F.substring(v, 4, 1_000_000), "[^0-9]", "")
    body = F.when(v.startswith("+91"), behind).when((F.length(digits) == 12) & digits.startswith("91"), F.substring(digits, 3, 10)).otherwise(digits)
    return F.when(F.length(body) == 10, F.concat(F.lit("+91-"), body))


def email(c: Column) -> Column:
    v = F.replace(F.lower(trimmed(c)), F.lit("@@"), F.lit("@"))
    return F.when(v.rlike(EMAIL), v)


def boolean(c: Column) -> Column:
    """True or false by their usual words, null for all else."""
    v = F.lower(trimmed(c))
    return F.when(v.isin(*TRUE_WORDS), F.lit(True)).when(v.isin(*FALSE_WORDS), F.lit(False))


def first_number(c: Column) -> Column:
    """The first run of digits as a bigint, null without one."""
    return F.nullif(F.regexp_extract(c, r"[0-9]+", 0), F.lit("")).try_cast("bigint")


def printed(c: Column, kind: T.DataType) -> Column:
    """A value as row hashes show it: null as nothing, booleans capitalised, timestamps to the second."""
    if isinstance(kind, T.BooleanType):
        shown = F.initcap(c.cast("string"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        shown = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    else:
        shown = c.cast("string")
    return F.coalesce(shown, F.lit(""))


def row_hash(columns: list[tuple[Column, T.DataType]]) -> Column:
    """sha256 of the printed values joined by |; nulls keep their place."""
    return F.sha2(F.array_join(F.array(*[printed(c, k) for c, k in columns]), "|"), 256)
