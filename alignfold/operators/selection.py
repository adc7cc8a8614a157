"""The first n rows of an order, found without bringing them together.

A histogram of the first order column says in which bin the n-th row lies. Rows of the bins before it are
taken where they are; the bin itself is cut finer until it is small or holds one value only, and its rows
alone are ranked, over range partitions. Only histograms, of at most BINS rows each, reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alignfold.functions.text import col_of

BINS = 4096
RANKED = 50_000  # rows of the last bin from which it is cut finer
PREFIX = 6  # bytes of a string that one number holds

OrderItem = str | Column | tuple  # ascending, or (column, "desc")


def order_item(item: OrderItem) -> tuple[Column, bool]:
    """(column, whether it descends)."""
    if isinstance(item, tuple):
        col, way = item
        if way not in ("asc", "desc"):
            raise ValueError(f"no such order: {way!r}")
        return col_of(col), way == "desc"
    return col_of(item), False


def sort_columns(order: Sequence[OrderItem]) -> list[Column]:
    """Nulls come first in ascending columns and last in descending ones, as is Spark's default."""
    return [c.desc() if down else c.asc() for c, down in map(order_item, order)]


def magnitude(col: Column, kind: T.DataType, level: int) -> tuple[Column, tuple[float, float] | None]:
    """(a double that never falls where ``col`` rises, its bounds if they are known). Strings are read PREFIX
    bytes at a time, from ``level`` on. Numbers go by their logarithm, so that outliers leave bins to the rest."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        part = F.substring(col.cast("binary"), PREFIX * level + 1, PREFIX)
        number = F.conv(F.hex(F.rpad(part, PREFIX, F.lit(b"\0"))), 16, 10).cast("double")
        return number, (0.0, float(256 ** PREFIX))
    if isinstance(kind, (T.DateType, T.TimestampType)):
        col = F.unix_date(col) if isinstance(kind, T.DateType) else col
    elif isinstance(kind, T.TimestampNTZType):
        col = F.unix_date(col.cast("date"))
    elif not isinstance(kind, (T.NumericType, T.BooleanType)):
        raise ValueError(f"no order of {kind.simpleString()} columns here; put another column first")
    x = col.cast("double")
    size = F.log1p(F.abs(x))
    # NaN is the greatest value; no finite logarithm reaches 1000
    return F.when(F.isnan(x), 1000.0).otherwise(F.signum(x) * F.least(size, F.lit(999.0))), None


def first_n(df: DataFrame, n: int, order: Sequence[OrderItem], ranked: int = RANKED, bins: int = BINS) -> DataFrame:
    """The first ``n`` rows (all, if there are no more) in a total order given by ``order``, sorted.

    ``order`` holds columns, names or (column, "desc"). ``df`` is read a few times, with its order columns
    alone until the end, and must give the same rows each time; its rows with many equal values in the
    first order column are ranked by the others. Of rows that are equal in all of ``order`` any may be taken.
    """
    from alignfold.operators.splits import IDX, with_row_index

    if n <= 0:
        return df.limit(0)
    col, down = order_item(order[0])
    kind = df.select(col.alias("c")).schema["c"].dataType
    below, inside, need, level, bounds = F.lit(False), F.lit(True), n, 0, None
    while True:
        size, known = magnitude(col, kind, level)
        if bounds is None and known is None:
            r = df.filter(inside).agg(F.min(size), F.max(size)).first()
            known = (r[0], r[1]) if r[0] is not None else (0.0, 0.0)
        low, high = bounds or known
        # nulls stand in a bin of their own, before or after all others
        at = F.floor((size - F.lit(low)) / F.lit((high - low) or 1.0) * F.lit(float(bins - 1))).cast("int")
        at = F.coalesce(F.lit(bins) - at if down else at, F.lit(bins + 1 if down else -1))
        held = df.filter(inside).select(at.alias("at"), size.alias("size")).groupBy("at").agg(
            F.count(F.lit(1)).alias("n"), F.min("size").alias("low"), F.max("size").alias("high")).collect()
        before, cut = 0, None
        for r in sorted(held, key=lambda r: r["at"]):
            if before + r["n"] >= need:
                cut = r
                break
            before += r["n"]
        if cut is None:  # fewer rows than asked for
            return df.orderBy(*sort_columns(order))
        below, inside, need = below | (inside & (at < cut["at"])), inside & (at == cut["at"]), need - before
        if need == cut["n"]:
            below, inside = below | inside, F.lit(False)
            break
        one_value = cut["low"] is None or cut["low"] == cut["high"]
        text = isinstance(kind, (T.StringType, T.BinaryType)) and cut["low"] is not None
        if cut["n"] <= ranked or (one_value and not (text and level < 16)):
            break
        level, bounds = (level + 1, None) if one_value else (level, (cut["low"], cut["high"]))
    taken = df.filter(below)
    if need < cut["n"]:
        last = with_row_index(df.filter(inside), sort_columns(order))
        taken = taken.unionByName(last.filter(F.col(IDX) < need).drop(IDX))
    return taken.orderBy(*sort_columns(order))
