"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tintwell.operators.scratch import drop, ship, staged

SALTS = 16
#: So many arcs are settled in one task, wherever they lay.
FEW = 200_000
#: Types whose order in Python is Spark's.
PLAIN = ("tinyint", "smallint", "int", "bigint", "string")


def _star(arcs: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and its neighbours. A node with very many arcs is dealt over SALTS join keys."""
    least = arcs.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
    least = least.select("*", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("s"))
    return arcs.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least.hint("merge"), ["u", "s"])


def forest(arcs: list[tuple]) -> list[tuple]:
    """(node, root) for every node of the arcs (u, v) but the roots: root is the smallest node that these arcs reach."""
    up: dict = {}

    def find(x):
        while (above := up.setdefault(x, x)) != x:
            up[x] = x = up[above]
        return x

    for u, v in arcs:
        u, v = find(u), find(v)
        if u != v:
            up[max(u, v)] = min(u, v)
    return [(x, r) for x in up if (r := find(x)) != x]


def _plain(arcs: DataFrame) -> bool:
    return arcs.schema["u"].dataType.simpleString() in PLAIN


def _contracted(arcs: DataFrame, most: int = FEW) -> DataFrame:
    """Stars in place of the arcs, for each run of at most ``most`` arcs or one Arrow batch that lie together in a partition.

    Nodes stay connected as they were, and no node's smallest neighbour becomes larger.
    """
    if not _plain(arcs):
        return arcs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, schema = [], None
        for batch in batches:
            schema = batch.schema
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            if len(held) >= most:
                held = forest(held)
                if 2 * len(held) >= most:
                    yield pa.RecordBatch.from_arrays([pa.array([a[k] for a in held], schema.field(k).type) for k in (0, 1)], schema=schema)
                    held = []
        if held:
            held = forest(held)
            yield pa.RecordBatch.from_arrays([pa.array([a[k] for a in held], schema.field(k).type) for k in (0, 1)], schema=schema)

    ship(arcs.sparkSession)
    return arcs.mapInArrow(run, arcs.schema)


def _settled(arcs: DataFrame) -> bool:
    """Whether every node either has one arc down or is a root."""
    ends = arcs.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("n")), F.struct(F.col("v").alias("node"), F.lit(0).alias("n")))).alias("e")).select("e.*")
    open_nodes = ends.groupBy("node").agg(F.sum("n").alias("down"), F.min("n").alias("least")).where("down > 1 or down = 1 and least = 0")
    return open_nodes.agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node of edges (u, v): root is the smallest node that it can reach.

    Nodes are of one orderable type. Loops and repeated edges are ignored. Every round is written as a table, whose arcs
    are contracted where they lie. Once FEW are left, over however many partitions, one task settles them. The loop ends
    when every arc leads to a root, which is certain: a round lowers the smallest neighbour of some node, and raises none,
    until all arcs do.
    """
    arcs = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, gathered = staged(_contracted(arcs), "arcs"), False
    for _ in range(max_rounds):
        if not gathered and _plain(now) and now.count() <= FEW:
            spread, now, gathered = now, staged(_contracted(now.coalesce(1)), "arcs"), True
            drop(spread)
        if _settled(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        stars = _star(large)
        small = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(stars.select("u", F.col("m").alias("v")))
        after = staged(_contracted(small.where("u <> v").distinct()), "arcs")
        drop(now)
        now = after
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
