"""Connected components of an edge table, by alternating large-star and
small-star rounds (joins and grouped minima; nothing passes the driver but
one row of counts a round)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.session import checkpoint_dir

#: edges of a partition; smaller tables lie in fewer partitions than the session shuffles into
EDGES = 250_000


def cut(df: DataFrame) -> DataFrame:
    """The frame read back from the shared checkpoint folder: its lineage is cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Checkpoints of one run, each in a folder of its own under the shared
    checkpoint folder, so that it can be deleted after its last reader. Whatever is
    computed from a dropped frame must have been written or kept before."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.shared = checkpoint_dir(spark)
        self.path = f"{self.shared}/scratch-{uuid.uuid4().hex}"
        self._kept: list[tuple[DataFrame, str]] = []

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.path}/{len(self._kept)}"
        self.spark.sparkContext.setCheckpointDir(path)
        out = df.checkpoint()
        self.spark.sparkContext.setCheckpointDir(self.shared)
        self._kept.append((out, path))
        return out

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            for kept, path in self._kept:
                if kept is frame:
                    delete(self.spark, path)

    def close(self) -> None:
        """Drops all that was kept."""
        delete(self.spark, self.path)
        self._kept.clear()


def components(edges: DataFrame, max_rounds: int = 64, scratch: Scratch | None = None) -> DataFrame:
    """``edges`` (a, b: long) to (node, component): the smallest node reachable.

    Nodes without an edge are not listed. Self loops and repeated edges are
    allowed; rows with a null end are left out. An empty table gives an empty
    table. A hub's rows are reduced by a grouped minimum with map-side
    combine; the join that hands the minimum back is one AQE can split.
    A round's table is deleted once the next one is written; the last one is
    kept in ``scratch``.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    e = (edges.where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = scratch.keep(e)
    parts = max(1, -(-e.count() // EDGES))
    state = None
    for _ in range(max_rounds):
        last, e = e, scratch.keep(_small_star(_large_star(e.coalesce(parts), parts), parts))
        scratch.drop(last)
        row = e.agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"),
                    F.sum(F.hash("u", "v").cast("long")).alias("h")).first()
        now = (row["n"], row["s"], row["h"])
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _large_star(e: DataFrame, parts: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.where("v > u").join(least.coalesce(parts), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.coalesce(parts).distinct().coalesce(parts)


def _small_star(e: DataFrame, parts: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    e = e.where("u <> v")
    least = e.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts)
    rest = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).coalesce(parts).distinct().coalesce(parts)
