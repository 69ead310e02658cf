"""Connected components of an edge table: union-find inside tasks, stars across them.

Every round contracts the edges of each partition by union-find, then hangs each node's larger
neighbours on its smallest one, and each node and its smaller neighbours on the smallest of
them. Both steps need one number per node, which is aggregated before the shuffle and joined
back, so a hub with most of the edges is no hot key. Rounds end when no edge changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import few_files, settle

MAX_ROUNDS = 60


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a partition as stars around the least node of each group."""
    parent: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent[x]
        return root

    def flush() -> pa.RecordBatch:
        pairs = [(x, find(x)) for x in list(parent)]
        pairs = [(x, r) for x, r in pairs if x != r]
        columns = [pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)]
        parent.clear()
        return pa.record_batch(columns, ["u", "v"])

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:
            yield flush()
    yield flush()


def _least(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))


def _both_ways(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return edges.select("u", "v").unionAll(back)


def _round(edges: DataFrame, n: int) -> DataFrame:
    """Large star, then small star, of ``n`` edges."""
    both = _both_ways(edges)
    hung = (
        both.join(_least(both), "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )
    hung = settle(few_files(hung, n), "stars")
    # Every edge points downwards here: u > v.
    least = _least(hung)
    down = hung.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return down.unionAll(own).filter(F.col("u") != F.col("v")).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): of every node that has an edge, the least node it can reach.

    ``edges`` has binary columns u and v, in any direction, repeats and loops allowed.
    """
    contracted = edges.select("u", "v").mapInArrow(_contract, "u binary, v binary")
    now = settle(contracted.distinct(), "edges")
    before = _print(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        now = settle(few_files(_round(now, before[0]), before[0]), "edges")
        after = _print(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionAll(roots)
