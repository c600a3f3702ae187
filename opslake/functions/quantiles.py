"""Exact quantiles that never gather one group's values into one task.

Spark's exact ``percentile`` keeps, per group, a map from each distinct value
to its count and merges those maps in a single task. A measure can have about
as many distinct values as rows, and then one hot group has to fit in one task.

``exact_quantiles`` computes the same numbers (Spark's ``percentile``
formula: position = (n - 1) * p, linear interpolation between the values at
the floor and ceiling ranks) by selecting ranks in histograms of all groups
at once, refined twice:

1. rows are counted per (group, value) -- a partial aggregate, keyed by the
   value too, so a hot group is spread over many tasks;
2. a first histogram per group has a bin for each thousandth of the value
   (the logarithm's steps, at most 3 million bins for all doubles); running sums over the bins give for each wanted rank its bin and
   its rank inside;
3. each such bin is cut into FINE equal parts between its smallest and largest
   value, and again the part with the wanted rank is found;
4. such a part spans less than one in 10**9 of the value: not more than about
   5 million doubles exist in it. Running sums over its distinct values give the value.

Every window sees rows of one bounded histogram. The plan is one query: no
job runs while it is built, nothing is collected, sampled or checkpointed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions.exprs import quantile

#: bins of the first histogram per factor e of the value, and parts of a bin
STEPS, FINE = 1024, 1 << 21


# a number that never falls as the double v rises. ``ln`` is strict arithmetic: the same on every machine, and
# monotonic; 746 lifts the smallest double above 0, 710 is above the largest finite one
_COARSE = """CASE WHEN isnan(_v) THEN {nan}L WHEN _v = 0 THEN 0L
  ELSE CAST(sign(_v) AS BIGINT) * (CAST(floor((least(ln(abs(_v)), 710D) + 746D) * {steps}D) AS BIGINT) + 1L) END"""
# the part of [_low, _high] that holds v, 0 to FINE; never falls as v rises
_FINE = "CASE WHEN _high > _low THEN CAST(floor((_v - _low) / nullif(_high - _low, 0D) * {fine}D) AS BIGINT) ELSE 0L END"


@dataclass(frozen=True)
class Q:
    """A quantile measure for ``agg_with_quantiles``: value column (nulls
    ignored, so a ``when``-guarded column restricts the population),
    probability and rounding digits."""
    value: object
    p: float
    digits: int = 2


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _quantiles(df: DataFrame, by: list[str], measures: dict[str, str | Column], outputs: dict[str, tuple[str, float, int | None]],
               weight: str | Column | None = None, beside: dict[str, Column] | None = None) -> DataFrame:
    """``by`` and ``outputs`` (name: measure, probability, digits) for each
    group; with ``beside`` (ordinary aggregates by name) for each group of
    ``df``, and those columns too. The whole is one statement, so that
    the plan of ``df`` is analysed few times."""
    # the groups' own names stay out of the statement
    groups = [f"_g{i}" for i in range(max(1, len(by)))]
    keys = [k.alias(g) for k, g in zip([F.col(c) for c in by] or [F.lit(0)], groups)]
    times = F.lit(1) if weight is None else _col(weight)
    values = [_col(c).cast("double") for c in measures.values()]
    # measures are stacked into (number, value) rows
    stacked = F.inline(F.array(*[F.struct(F.lit(i).alias("_m"), v.alias("_v")) for i, v in enumerate(values)]))
    frames = {"rows": df.select(*keys, times.cast("long").alias("_w"), stacked)}
    probs = sorted({p for _, p, _ in outputs.values()})

    g = ", ".join([*groups, "_m"])
    own = ", ".join(f"c.{c}" for c in [*groups, "_m"])
    same = " AND ".join(f"c.{c} <=> w.{c}" for c in [*groups, "_m", "_bin"])  # <=> keeps the plans of counts alike, for reuse
    coarse, fine = _COARSE.format(nan=1 << 40, steps=STEPS), _FINE.format(fine=FINE)
    labels = list(measures)

    def place(p: float, n: str = "_n") -> str:
        return f"CAST({n} - 1 AS DOUBLE) * {float(p)!r}D"

    ranks = ", ".join(f"named_struct('t', {2 * i + up}, 'r', CAST({f}({place(p)}) AS BIGINT))"
                      for i, p in enumerate(probs) for up, f in enumerate(("floor", "ceil")))
    used = sorted({(labels.index(m), probs.index(p)) for m, p, _ in outputs.values()})
    picks = ", ".join([f"max(CASE WHEN _m = {m} THEN _n END) AS _n{m}" for m in sorted({m for m, _ in used})] + [
        f"max(CASE WHEN _m = {m} AND _t = {t} THEN _v END) AS _v{m}_{t}" for m, i in used for t in (2 * i, 2 * i + 1)])

    def between(m: int, i: int) -> str:
        at, low, high = place(probs[i], f"_n{m}"), f"_v{m}_{2 * i}", f"_v{m}_{2 * i + 1}"
        return (f"CASE WHEN ceil({at}) = floor({at}) OR {high} = {low} THEN {low} "
                f"ELSE (ceil({at}) - {at}) * {low} + ({at} - floor({at})) * {high} END")

    columns = {name: between(labels.index(m), probs.index(p)) for name, (m, p, _) in outputs.items()}
    columns = {name: c if outputs[name][2] is None else f"round({c}, {outputs[name][2]})" for name, c in columns.items()}
    result = ", ".join(f"{c} AS _o{i}" for i, c in enumerate(columns.values()))
    k = ", ".join(groups)
    names = [f"{{side}}.{c} AS `{name}`" for c, name in zip(groups, by)]
    picked = [f"q._o{i} AS `{name}`" for i, name in enumerate(outputs)]
    source, side = "quantiles q", "q"
    if beside is not None:
        plain = df.groupBy(*keys) if by else df
        frames["plain"] = plain.agg(*[c.alias(f"_a{i}") for i, c in enumerate(beside.values())])
        both = [f"_a{i} AS `{name}`" for i, name in enumerate(beside)]
        if by:
            source = "{plain} a LEFT JOIN quantiles q ON " + " AND ".join(f"a.{c} <=> q.{c}" for c in groups)
            picked, side = picked + [f"a.{c}" for c in both], "a"
        else:  # one row each, put side by side without a join
            holes = [f"NULL AS _a{i}" for i in range(len(beside))], [f"NULL AS _o{i}" for i in range(len(outputs))]
            source = (f"(SELECT {', '.join([f'_a{i}' for i in range(len(beside))] + holes[1])} FROM {{plain}} UNION ALL "
                      f"SELECT {', '.join(holes[0] + [f'_o{i}' for i in range(len(outputs))])} FROM quantiles)")
            picked = [f"max(_o{i}) AS `{name}`" for i, name in enumerate(outputs)]
            picked += [f"max(_a{i}) AS `{name}`" for i, name in enumerate(beside)]
    names = [n.format(side=side) for n in names]
    return df.sparkSession.sql(f"""
WITH counts AS (  -- rows of each distinct value
  SELECT {g}, _v, _c, {coarse} AS _bin FROM (
    SELECT {g}, _v, sum(_w) AS _c FROM {{rows}} WHERE _v IS NOT NULL GROUP BY {g}, _v)),
bins AS (
  SELECT *, sum(_c) OVER (PARTITION BY {g}) AS _n,
    sum(_c) OVER (PARTITION BY {g} ORDER BY _bin ROWS UNBOUNDED PRECEDING) AS _end
  FROM (SELECT {g}, _bin, sum(_c) AS _c, min(_v) AS _low, max(_v) AS _high FROM counts GROUP BY {g}, _bin)),
wanted AS (  -- the bin of each wanted rank, and its rank inside
  SELECT {g}, _bin, _low, _high, _n, _w.t AS _t, _w.r - (_end - _c) AS _r
  FROM bins LATERAL VIEW explode(filter(array({ranks}), x -> x.r >= _end - _c AND x.r < _end)) AS _w),
parts AS (
  SELECT *, sum(_c) OVER (PARTITION BY {g}, _t ORDER BY _part ROWS UNBOUNDED PRECEDING) AS _end
  FROM (SELECT {own}, _t, {fine} AS _part, sum(_c) AS _c, any_value(_r) AS _r, any_value(w._bin) AS _bin,
          any_value(_low) AS _low, any_value(_high) AS _high, any_value(_n) AS _n
        FROM counts c JOIN wanted w ON {same} GROUP BY {own}, _t, {fine})),
refined AS (
  SELECT {g}, _t, _bin, _low, _high, _n, _part, _r - (_end - _c) AS _r FROM parts WHERE _r >= _end - _c AND _r < _end),
found AS (
  SELECT *, sum(_c) OVER (PARTITION BY {g}, _t ORDER BY _v ROWS UNBOUNDED PRECEDING) AS _end
  FROM (SELECT {own}, _t, _v, _c, _r, _n FROM counts c JOIN refined w ON {same} WHERE {fine} = _part)),
quantiles AS (
  SELECT {k}, {result} FROM (
    SELECT {k}, {picks} FROM found WHERE _r >= _end - _c AND _r < _end GROUP BY {k}))
SELECT {", ".join([*names, *picked])} FROM {source}""", **frames)


def exact_quantiles(df: DataFrame, value: str | Column, probs: dict[str, float],
                    by: list[str] | None = None, weight: str | Column | None = None) -> DataFrame:
    """One row per group (``by``) with one double column per entry of
    ``probs`` (name -> probability in [0, 1]). Null values are ignored; a
    group without any non-null value has no row (a left join from the
    group's other aggregates gives null, as ``percentile`` does).
    ``weight`` (a positive integer column) counts a row that many times,
    like ``percentile``'s frequency."""
    return _quantiles(df, list(by or []), {"x": value}, {n: ("x", p, None) for n, p in probs.items()}, weight)


def agg_with_quantiles(df: DataFrame, measures: list[tuple[str, Column | Q]], by: list[str] | None = None,
                       approx: bool = False, distributed: bool | None = None, weight: str | Column | None = None) -> DataFrame:
    """Aggregate ``measures`` (name, Column aggregate or ``Q``) per ``by``
    group, columns in the given order.

    Quantiles are exact and computed as above, all in one statement with the
    other aggregates; no group's values meet in one task.
    ``distributed=False`` uses Spark's
    ``percentile`` instead (the same values from one value map per group,
    for domains known to be small), ``approx`` the bounded sketch.
    ``weight`` is the quantiles' only.
    """
    if approx and distributed:
        raise ValueError("approx and distributed exclude each other")
    by = list(by or [])
    if approx or distributed is False or not any(isinstance(m, Q) for _, m in measures):
        return df.groupBy(*by).agg(*[F.round(quantile(m.value, m.p, approx, weight=weight), m.digits).alias(n)
                                     if isinstance(m, Q) else m.alias(n) for n, m in measures])
    values: dict[str, tuple[str, Column]] = {}     # one stacked measure per distinct value column
    outputs: dict[str, tuple[str, float, int]] = {}
    for n, m in measures:
        if isinstance(m, Q):
            c = _col(m.value)
            label = values.setdefault(str(c), (f"m{len(values)}", c))[0]
            outputs[n] = (label, m.p, m.digits)
    out = _quantiles(df, by, dict(values.values()), outputs, weight, {n: m for n, m in measures if not isinstance(m, Q)})
    return out.select(*by, *[n for n, _ in measures])
