"""Distributed exact quantiles equal Spark's exact ``percentile``."""

import random

import pytest
from pyspark.sql import functions as F

from opslake.functions.quantiles import exact_quantiles

PROBS = {"p0": 0.0, "p33": 0.333, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p100": 1.0}


def _rows(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(6000):
        g = "hot" if i % 3 == 0 else f"g{i % 5}"          # one group holds a third of the rows
        v = None if i % 13 == 0 else (round(rnd.gauss(30, 10), 3) if i % 2 else float(i % 17))  # ties
        rows.append((g, v))
    return rows + [("single", 5.0), ("nulls", None), ("two", 1.0), ("two", 2.0)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_grouped_and_global_match_percentile(spark, seed):
    df = spark.createDataFrame(_rows(seed), "g string, v double")
    got = {r.g: r.asDict() for r in exact_quantiles(df, "v", PROBS, by=["g"]).collect()}
    exp = {r.g: r.asDict() for r in df.groupBy("g").agg(
        *[F.percentile("v", F.lit(p)).alias(k) for k, p in PROBS.items()]).collect()}
    assert "nulls" not in got and exp.pop("nulls")["p50"] is None
    assert got == exp
    one = exact_quantiles(df, "v", PROBS).first().asDict()
    assert one == df.agg(*[F.percentile("v", F.lit(p)).alias(k) for k, p in PROBS.items()]).first().asDict()


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_VALUES = st.one_of(st.none(), st.sampled_from([-2.5, 0.0, 1.0, 1.0, 3.25, 7.0]),
                    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False),
                    st.floats(allow_nan=False, allow_infinity=True))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 2), _VALUES), min_size=1, max_size=60),
       p=st.floats(0.0, 1.0))
def test_random_inputs_match_percentile(spark, rows, p):
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.q for r in exact_quantiles(df, "v", {"q": p}, by=["g"]).collect()}
    exp = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", F.lit(p)).alias("q")).collect()
           if r.q is not None}
    assert got == exp


def test_distributed_option_matches_default_in_every_operator(spark):
    from fixtures.catalog import Ctx
    from opslake.operators import contracts as K
    from opslake.operators import journeys as J
    from opslake.operators import lifecycle as L
    from opslake.operators import marts as M
    c = Ctx(spark, "/root/testdata/sf0.001")
    cases = {
        "kpi_summary": lambda d: M.kpi_summary(c.fact, distributed=d),
        "kpi_by_cluster": lambda d: M.kpi_by_cluster(c.fact, distributed=d),
        "model_summary": lambda d: L.model_summary(c.fact, distributed=d),
        "late_summary": lambda d: J.late_summary(c.prep, distributed=d),
        "late_by_category": lambda d: J.late_by_category(c.prep, distributed=d),
        "late_by_category_ordered": lambda d: J.late_by_category_ordered(c.prep, distributed=d),
        "late_by_band": lambda d: J.late_by_band(c.prep, distributed=d),
        "delay_by_support": lambda d: J.delay_by_support(c.journey, distributed=d),
        "late_by_intervened": lambda d: J.late_by_intervened(c.journey, distributed=d),
        "freshness_lag": lambda d: K.freshness_lag(c.t.restaurant_status, c.prep, distributed=d),
        "late_by_intervention_type": lambda d: J.late_by_intervention_type(c.t.interventions, c.outcome,
                                                                           distributed=d),
    }
    for name, build in cases.items():
        a, b = build(False), build(True)
        assert a.columns == b.columns, name
        assert a.collect() == b.collect(), name


def test_weighted_match_percentile_with_frequency(spark):
    rows = [(g, float(v % 11), 1 + v % 4) for g in range(3) for v in range(200 + 50 * g)]
    df = spark.createDataFrame(rows, "g int, v double, w int")
    got = {r.g: r.asDict() for r in exact_quantiles(df, "v", PROBS, by=["g"], weight="w").collect()}
    exp = {r.g: r.asDict() for r in df.groupBy("g").agg(
        *[F.percentile("v", F.lit(p), F.col("w")).alias(k) for k, p in PROBS.items()]).collect()}
    assert got == exp


def test_values_of_all_sizes_match_percentile(spark):
    """Values that share a bin or a part of one, both signs, infinities and many equal ones."""
    rnd = random.Random(5)
    near = [30.0 + i * 2.0 ** -48 for i in range(400)]
    xs = near + [-x for x in near] + [0.0] * 300 + [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-300, 300) for _ in range(900)]
    xs += [5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf"), float("nan"), float("nan")]
    rnd.shuffle(xs)
    df = spark.createDataFrame([(i % 3, x) for i, x in enumerate(xs)], "g int, v double")
    probs = {f"p{i}": i / 37 for i in range(38)}
    got = {r.g: r.asDict() for r in exact_quantiles(df, "v", probs, by=["g"]).collect()}
    exp = {r.g: r.asDict() for r in df.groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(k) for k, p in probs.items()]).collect()}
    assert {g: {k: repr(v) for k, v in r.items()} for g, r in got.items()} == {
        g: {k: repr(v) for k, v in r.items()} for g, r in exp.items()}


def test_no_job_runs_while_the_plan_is_built_and_none_keeps_a_value_map(spark):
    from opslake.functions.quantiles import Q, agg_with_quantiles
    df = spark.createDataFrame([(1, 2.0)], "g int, v double")
    spark.sparkContext.setJobGroup("quantile plan", "")
    try:
        out = agg_with_quantiles(df, [("n", F.count(F.lit(1))), ("m", Q("v", 0.5))], by=["g"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("quantile plan")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "rangepartitioning" not in plan
