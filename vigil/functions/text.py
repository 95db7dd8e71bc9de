"""Normalisation of texts and of the sentinels that stand for missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Neither null, blank, nor the sentinel NA."""
    return c.isNotNull() & (F.trim(c) != "") & (F.upper(F.trim(c)) != "NA")


def flag(c: Column) -> Column:
    """A boolean from 1, true, yes or y."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("1", "true", "yes", "y"), F.lit(False))


def number(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(c.cast("string").try_cast("double"), F.lit(default))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f\x0B]+", " "))


def tokens(c: Column, least: int = 3) -> Column:
    """Distinct alphanumeric words of at least so many characters, in order of appearance."""
    return F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: F.length(x) >= least))


def pipe_list(c: Column) -> Column:
    """Distinct trimmed items of a list joined by '|', in order of appearance."""
    return F.array_distinct(F.filter(F.transform(F.split(c, r"\|"), lambda x: F.trim(x)), lambda x: x != ""))
