"""Column expressions shared by every operator.

These encode the null / rounding / timestamp rules the results depend on:
- durations in minutes from microsecond differences (no truncation),
- clips that keep null as null (``greatest(null, 0)`` would give 0),
- strip that removes every kind of leading/trailing whitespace,
- rates where a null comparison counts as False but stays in the denominator,
- divisions guarded with ``nullif`` (ANSI mode raises on /0).
All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def minutes_between(start, end) -> Column:
    """(end - start) in minutes as double; null if either side is null."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(6e7)


def seconds_between(start, end) -> Column:
    """(end - start) in seconds as double."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)


def clip_low(x, lo: float = 0.0) -> Column:
    x = _c(x)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(x, F.lit(float(lo))))


def clip(x, lo: float, hi: float) -> Column:
    x = _c(x)
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi))))


def norm_category(x) -> Column:
    """strip (all whitespace) + lower."""
    return F.lower(F.regexp_replace(_c(x), r"^\s+|\s+$", ""))


def pct(num, den, scale: int = 2) -> Column:
    """round(100 * num / den, scale) with den = 0 -> null."""
    return F.round(F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0)), scale)


def rate_true(cond: Column) -> Column:
    """Mean of a predicate where null counts as False (pandas mask semantics)."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("double"))


def quantile(x, p: float, approx: bool = False, accuracy: int = 10000, weight=None) -> Column:
    """Linear-interpolated quantile (= percentile_cont). ``approx`` switches to
    the bounded-memory sketch for very large single groups. ``weight`` (a
    positive integer column) counts a row that many times, so rows can be
    pre-aggregated before a shuffle (exact quantile only)."""
    if approx:
        if weight is not None:
            raise ValueError("weighted quantiles are exact only")
        return F.percentile_approx(_c(x).cast("double"), p, accuracy)
    if weight is not None:
        return F.percentile(_c(x).cast("double"), F.lit(p), _c(weight))
    return F.percentile(_c(x).cast("double"), F.lit(p))


def parse_ts(x) -> Column:
    """String -> timestamp (session zone UTC); unparseable text -> null.

    Accepts ``yyyy-MM-dd HH:mm:ss``, ``yyyy-MM-ddTHH:mm:ss`` and the ``Z``
    suffixed ISO form, with or without fractions. Already-typed timestamps
    pass through.
    """
    return _c(x).try_cast("timestamp")


def as_timestamps(df: DataFrame, cols: list[str]) -> DataFrame:
    """The text columns among ``cols`` parsed (bad text -> null), others as they are."""
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.withColumns({c: parse_ts(c) for c in cols if c in text})


def fmt_ts(x) -> Column:
    return F.date_format(_c(x), "yyyy-MM-dd HH:mm:ss")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where missing keys are equal to each other; the
    left side's keys are kept."""
    r = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(r, on, how).drop(*[f"_right_{k}" for k in keys])


def combine_one_row(*frames: DataFrame) -> DataFrame:
    """Put several one-row aggregates side by side without a join.

    Each frame must have distinct column names. Union with missing columns,
    then collapse to one row (each column has exactly one non-null value).
    """
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    cols = [c for f in frames for c in f.columns]
    return u.agg(*[F.max(c).alias(c) for c in cols])
