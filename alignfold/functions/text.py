"""Text column functions shared by every operator (strip, hit counts, hashing).

Each function has a Spark form (returns a Column) and, where an oracle needs it,
a SQL form (returns a DuckDB/ANSI expression string) that computes the same value.
"""

from __future__ import annotations

import sys
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes every code point for which str.isspace() is true.
# Derived by rule, not listed: Spark's trim() alone misses 28 of them (e.g. U+3000).
PY_WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()`` on a string column (Unicode whitespace, both ends)."""
    return F.trim(col_of(c), F.lit(PY_WHITESPACE))


def strip_sql(expr: str) -> str:
    return f"trim({expr}, '{PY_WHITESPACE}')"


def blank(c) -> Column:
    """Null, empty or whitespace only."""
    return F.coalesce(strip(c), F.lit("")) == ""


def count_hits(c, terms: Sequence[str]) -> Column:
    """Number of distinct terms that occur as case-sensitive substrings of ``c``.

    Overlapping terms each count once (a longer term also hits its shorter
    prefix term); the empty term occurs in every text. Null text gives 0 hits but for
    the empty term. One form for any number of terms: the terms are one constant array.
    """
    terms = list(dict.fromkeys(terms))
    if not terms:
        return F.lit(0)
    text = F.coalesce(col_of(c), F.lit(""))
    return F.size(F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(text, t)))


def count_hits_sql(expr: str, terms: Sequence[str]) -> str:
    terms = list(dict.fromkeys(terms))
    if not terms:
        return "0"
    parts = [f"(CASE WHEN contains(coalesce({expr}, ''), {sql_str(t)}) THEN 1 ELSE 0 END)" for t in terms]
    return "(" + " + ".join(parts) + ")"


def sql_str(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def content_hash(c) -> Column:
    """SHA-256 hex of the text: shuffles and compares 64 bytes instead of whole documents."""
    return F.sha2(col_of(c), 256)


def content_hash_sql(expr: str) -> str:
    return f"sha256({expr})"


def seeded_key(seed: int, key) -> Column:
    """Reproducible pseudo-random order key, identical in Spark and DuckDB."""
    return F.md5(F.concat(F.lit(f"{seed}:"), col_of(key).cast("string")))


def seeded_key_sql(seed: int, expr: str) -> str:
    return f"md5('{seed}:' || CAST({expr} AS VARCHAR))"


def hash_unit(seed: int, key) -> Column:
    """A deterministic number in [0, 1) from the seeded md5 (first 7 hex digits)."""
    return F.conv(F.substring(seeded_key(seed, key), 1, 7), 16, 10).cast("double") / F.lit(float(16 ** 7))


def hash_unit_sql(seed: int, expr: str) -> str:
    return f"(CAST(('0x' || substr({seeded_key_sql(seed, expr)}, 1, 7)) AS BIGINT) / {float(16 ** 7)})"


def as_instant(df, ts: str) -> Column:
    """Event time as an instant. TIMESTAMP_NTZ (wall clock, e.g. parquet without UTC adjustment)
    is read as UTC, so windows, watermarks and epoch buckets do not depend on the session zone."""
    from pyspark.sql import types as T

    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
        return F.timestamp_micros(micros)
    return F.col(ts)


def epoch_seconds(df, ts: str) -> Column:
    return F.unix_seconds(as_instant(df, ts))
