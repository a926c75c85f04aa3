"""Scalar functions over metadata, as column expressions, and helpers for column names."""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import Column, functions as F


def norm_null(value: Column) -> Column:
    """Null for blanks and for the words nan, none and null in any case; else the trimmed value."""
    bare = F.trim(value.cast("string"))
    return F.when(F.lower(bare).isin("", "nan", "none", "null"), F.lit(None)).otherwise(bare)


def safe_name(value: Column) -> Column:
    """A file name: everything but letters, digits, dots and hyphens to single underscores, 80 characters at most."""
    kept = F.regexp_replace(value, r"[^A-Za-z0-9.\-]+", "_")
    return F.regexp_replace(F.left(F.regexp_replace(kept, "_+", "_"), F.lit(80)), "^_+|_+$", "")


def url_quoted(value: Column) -> Column:
    """Percent-encoding, with %20 for a space."""
    return F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))


def percent(part: Column, whole: Column) -> Column:
    """A share as a percentage with one decimal, 0.0% for nothing of nothing."""
    return F.concat(F.format_number(F.coalesce(part * 100.0 / F.nullif(whole, F.lit(0)), F.lit(0.0)), 1), F.lit("%"))


def minutes_seconds(seconds: Column) -> Column:
    return F.concat(F.floor(seconds / 60).cast("string"), F.lit("m "), (seconds % 60).cast("string"), F.lit("s"))


def camel(name: str) -> str:
    """CamelCase of a name of several parts; a single part stays as it is."""
    parts = [p for p in re.split(r"[\s_\-]+", name.strip()) if p]
    return "".join(p[:1].upper() + p[1:].lower() for p in parts) if len(parts) > 1 else name


def camel_column(name: Column) -> Column:
    """``camel`` for values."""
    parts = F.split(F.trim(F.regexp_replace(name, r"[\s_\-]+", " ")), " ")
    joined = F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substring(p, 2, 1 << 30)))), "")
    return F.when(F.size(parts) > 1, joined).otherwise(name)


def with_retries(call: Callable, attempts: int = 5, first: float = 1.5, base: float = 2.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep):
    """The call's result; after a failure it waits first * base ** n seconds, ``most`` at most, and tries again."""
    for n in range(attempts):
        try:
            return call()
        except Exception:
            if n == attempts - 1:
                raise
            sleep(min(most, first * base**n))
