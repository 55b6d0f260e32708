"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.storage import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return int(row["n"]), int(row["s"] or 0)


#: Edges up to which one task joins them up; the stars serve any number.
FEW_EDGES = 200_000


def _few(edges: DataFrame) -> DataFrame:
    """The same for at most ``FEW_EDGES`` edges, in one task, by trees of least nodes."""

    def run(batches):
        import pyarrow as pa

        above: dict[int, int] = {}

        def top(node: int) -> int:
            while above[node] != node:
                above[node] = node = above[above[node]]
            return node

        for batch in batches:
            for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
                above.setdefault(u, u)
                above.setdefault(v, v)
                a, b = top(u), top(v)
                above[max(a, b)] = min(a, b)
        nodes = list(above)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(n) for n in nodes], pa.int64())], ["node", "comp"])

    return edges.coalesce(1).mapInArrow(run, "node long, comp long")


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``edges`` (u, v) that has another neighbour than itself: the smallest node that can be reached.

    A few edges are joined up in one task. Else each step links the larger neighbours of a node to its smallest neighbour, then the smaller ones, and writes the
    edges anew; the number of steps grows with the logarithm of the longest path. Minima are combined before rows move.
    Edges stay on shared storage; none reach the driver.
    """
    now = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges"
    )
    state = _state(now)
    if state[0] <= FEW_EDGES:
        return _few(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(lowest, "u")
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
        now = materialize(small.distinct(), "edges")
        after = _state(now)
        if after == state:
            break
        state = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots)
