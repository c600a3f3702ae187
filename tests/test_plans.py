"""Plan guards for every query of the library's own catalog: no cartesian product or nested
loop join (no pair emission), no Python UDF operator in the plan, and the
parquet scans read only pruned columns."""

import re

import pytest

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plans():
    """The library's own queries; those of the training-data subpackage may run
    Python in tasks and have tests of their own."""
    import __spark_entry__ as E
    from fixtures.catalog import QUERIES
    return {name: q for name, q in E.queries().items() if name in QUERIES}


@pytest.mark.parametrize("name", sorted(_plans()))
def test_plan_guards(spark, name):
    df = _plans()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    # the orders scan never reads the unused o_totalprice / o_orderpriority columns
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "o_totalprice" not in schema and "o_orderpriority" not in schema, (name, schema)


AGGREGATES = ("HashAggregateExec", "ObjectHashAggregateExec", "SortAggregateExec")


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _has_aggregate(node):
    return node.getClass().getSimpleName() in AGGREGATES or any(_has_aggregate(c) for c in _children(node))


def _global_windows(node):
    out = [node] if (node.getClass().getSimpleName() == "WindowExec" and node.partitionSpec().isEmpty()) else []
    for c in _children(node):
        out += _global_windows(c)
    return out


@pytest.mark.parametrize("name", sorted(_plans()))
def test_single_task_windows_run_over_grouped_rows(spark, name):
    """A window without a partition key runs in one task, so it may only
    see aggregated rows (one per category / slice), never raw rows."""
    plan = _plans()[name](spark, SF)._jdf.queryExecution().sparkPlan()
    for w in _global_windows(plan):
        assert _has_aggregate(w), f"{name}: global window over raw rows"


def test_global_window_guard_detects_raw_rows(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    raw = spark.range(100).withColumn("rn", F.row_number().over(Window.orderBy("id")))
    grouped = (spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
               .withColumn("rn", F.row_number().over(Window.orderBy("k"))))
    (w_raw,) = _global_windows(raw._jdf.queryExecution().sparkPlan())
    (w_grouped,) = _global_windows(grouped._jdf.queryExecution().sparkPlan())
    assert not _has_aggregate(w_raw) and _has_aggregate(w_grouped)


def test_library_source_rules():
    """No broadcast hints (sizes are left to the planner's checked
    threshold), no cross joins, no localCheckpoint anywhere in the library;
    operators never pull rows to the driver."""
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "opslake"
    for path in root.rglob("*.py"):
        code = "\n".join(line.split("#")[0] for line in path.read_text().splitlines())
        for banned in ("broadcast(", ".crossJoin(", "localCheckpoint("):
            assert banned not in code, (path.name, banned)
        if path.parent.name == "operators":
            for pull in (".collect()", ".toPandas()", ".toLocalIterator("):
                assert pull not in code, (path.name, pull)
