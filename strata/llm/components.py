"""Distributed union-find over (a, b) links.

Each partition first unites its own links (path halving in a dict of its own,
flushed when it holds ``LOCAL_LINKS`` links, so its memory is bounded), which
turns cliques and copies into one link per node. The remaining forest is then
joined across partitions by rounds of two steps on Spark: every node hands its
larger neighbours to its smallest one, then its smaller neighbours likewise.
Links keep their components, the number of rounds is logarithmic in practice,
and every round is a written table. No links or components reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import drop_scratch, ship, written

LOCAL_LINKS = 200_000


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict = {}

    def find(x):
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    def flush():
        pairs = [(x, r) for x in parent if (r := find(x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > LOCAL_LINKS:
            yield flush()
    if parent:
        yield flush()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link to a smaller one.

    ``links`` has two long columns; loops and repeated links are harmless.
    ``component`` is the smallest node reachable; a node that is missing from
    the result is its own component. Nulls must be removed by the caller.
    """
    spark = links.sparkSession
    ship(spark)
    a, b = links.columns
    start = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    now = written(start.where("a <> b").mapInArrow(_unite, "a long, b long"), "links")
    state = None
    while True:
        # a > b in every row: a node and a smaller neighbour
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        # larger neighbours of u go to u's smallest neighbour (or u itself)
        large = (now.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"),
                                                              F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        after = written(small, "links")
        seen = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                         F.countDistinct("a")).first()
        drop_scratch(now)
        now = after
        if tuple(seen) == state and seen[0] == seen[2]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = tuple(seen)
