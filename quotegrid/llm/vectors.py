"""Nearest neighbours by randomly rotated one-bit codes with exact reranking.

Index: every vector, less the centre of a bounded sample, is rotated by a random orthogonal
matrix and kept as the signs of its coordinates, packed into bits, with its length and the
inner product of its direction with its code (the correction). Search: the inner product of a
query direction with a vector direction is estimated as that of the rotated query with the
code, divided by the correction, and its error is at most

    ERROR_SCALE * sqrt((1 - correction^2) / correction^2) / sqrt(dimensions - 1)

up to a probability that falls as exp(-c * ERROR_SCALE^2). Queries meet the index in blocks of
bounded size: in a block a query keeps the vectors whose least possible distance is within the
k-th smallest greatest possible one, and computes the true distance, in double precision on the
original vectors, of those alone. The best k of each block compete for the result.

All rows are coded and all blocks searched: on vectors without cluster structure, partial
probing of coarse cells misses neighbours (half of 64 cells found half of them), so blocks are
no cells. Equal vectors are one entry with its ``k + 1`` least ids, as no more can be among the
k nearest; so copies in any number neither fill a block nor multiply the search.

Vectors that are null, zero, of no component, or hold a null, NaN or infinity take no part, nor
do rows without an id. Vectors of different lengths never meet. Ties go to the smaller id. An
id that occurs twice is two rows; a query never finds its own id. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotegrid.llm.common import settle

K = 10
ERROR_SCALE = 3.0
SEED = 5
SAMPLE_ROWS = 2_048
BLOCK_ROWS, QUERY_ROWS = 2_048, 2_048

INDEX = (
    "entry long, ids array<long>, size int, vector array<double>, code binary, length double, "
    "correction double"
)


def rotation(size: int) -> np.ndarray:
    """The random orthogonal matrix of a dimension, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths and corrections of vectors, one per row."""
    size = vectors.shape[1]
    apart = vectors - centre
    length = np.sqrt((apart * apart).sum(1))
    turned = apart @ rotation(size) / np.where(length > 0, length, 1)[:, None]
    correction = np.abs(turned).sum(1) / math.sqrt(size)
    return np.packbits(turned > 0, axis=1), length, np.where(length > 0, correction, 1.0)


def bounds(
    queries: np.ndarray,
    centre: np.ndarray,
    codes: np.ndarray,
    length: np.ndarray,
    correction: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible squared distance of every query to every coded vector."""
    size = queries.shape[1]
    apart = queries - centre
    far = np.sqrt((apart * apart).sum(1))
    turned = apart @ rotation(size) / np.where(far > 0, far, 1)[:, None]
    bits = np.unpackbits(codes, axis=1, count=size).astype(np.float64)
    # Signs are 2 * bit - 1.
    products = (2 * turned @ bits.T - turned.sum(1)[:, None]) / math.sqrt(size)
    estimate = products / correction
    error = ERROR_SCALE * np.sqrt(np.maximum(1 - correction**2, 0)) / correction
    error = error / math.sqrt(max(size - 1, 1))
    cross = 2 * far[:, None] * length
    middle = far[:, None] ** 2 + length**2 - cross * estimate
    spare = cross * error + 1e-9 * (1 + cross)
    return middle - spare, middle + spare


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, v in double precision."""
    v = F.col("embedding").cast("array<double>")
    infinite = float("inf")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite)
    return (
        vectors.select(F.col("vec_id").cast("bigint"), v.alias("v"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .filter(~F.exists("v", odd) & F.exists("v", lambda x: x != 0))
    )


def entries(rows: DataFrame, k: int) -> DataFrame:
    """(entry, ids, v): one row per distinct vector, with its least ids."""
    by_id = Window.partitionBy("v").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    grouped = few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("entry"), "ids", "v")


def centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """The mean of a bounded sample, per dimension that it holds."""
    picked = rows.select("vec_id", "v").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS)
    sample: dict[int, list] = {}
    for r in picked.select("v").collect():
        sample.setdefault(len(r["v"]), []).append(r["v"])
    return {size: np.array(v).mean(0) for size, v in sample.items()}


def _centre(found: dict[int, np.ndarray], size: int) -> np.ndarray:
    return found.get(size, np.zeros(size))


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def build_index(rows: DataFrame, k: int, found: dict[int, np.ndarray]) -> DataFrame:
    """The coded entries of all rows, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in INDEX.split(", ")]
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = table.column("size").to_numpy()
            for size in np.unique(sizes):
                part = table.filter(pa.array(sizes == size)).combine_chunks()
                code, length, correction = encode(
                    _matrix(part.column("v"), size), _centre(found, size)
                )
                columns = [
                    *(part.column(c).combine_chunks() for c in ("entry", "ids", "size", "v")),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    pa.array(length),
                    pa.array(correction),
                ]
                yield pa.record_batch(columns, names)

    sized = entries(rows, k).withColumn("size", F.size("v"))
    return settle(sized.mapInArrow(run, INDEX), "vector-index")


def _search(found: dict[int, np.ndarray], k: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, float, int]] = []
        if index.num_rows and queries.num_rows:
            size = index.column("size")[0].as_py()
            centre = _centre(found, size)
            vectors = _matrix(index.column("vector"), size)
            codes = np.frombuffer(b"".join(index.column("code").to_pylist()), np.uint8)
            length = index.column("length").to_numpy()
            correction = index.column("correction").to_numpy()
            codes = codes.reshape(len(vectors), -1)
            ids = index.column("ids").to_pylist()
            names = queries.column("asker").to_pylist()
            asked = _matrix(queries.column("v"), size)
            for low in range(0, len(names), 64):
                some = asked[low : low + 64]
                near, far = bounds(some, centre, codes, length, correction)
                kth = min(k, len(vectors) - 1)  # k + 1 entries hold k others
                limit = np.partition(far, kth, axis=1)[:, kth]
                for q, query in enumerate(some):
                    chosen = np.flatnonzero(near[q] <= limit[q])
                    apart = vectors[chosen] - query
                    true = np.sqrt((apart * apart).sum(1))
                    best = np.argsort(true, kind="stable")
                    if len(best) > k + 1:
                        best = best[true[best] <= true[best[k]]]
                    hits = sorted((true[b], i) for b in best for i in ids[chosen[b]])
                    out.extend((names[low + q], float(d), i) for d, i in hits[: k + 1])
        columns = list(zip(*out, strict=True)) or [[], [], []]
        kinds = (pa.int64(), pa.float64(), pa.int64())
        return pa.table(
            {
                n: pa.array(c, t)
                for n, c, t in zip(("entry", "score", "found"), columns, kinds, strict=True)
            }
        )

    return run


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest other rows."""
    rows = usable(vectors)
    found = centres(rows)
    index = build_index(rows, k, found)
    asking = settle(
        rows.filter(is_query)
        .join(index.select(F.col("vector").alias("v"), "entry"), "v")
        .select("vec_id", "entry"),
        "vector-queries",
    )
    # One query per distinct vector; its copies share the result.
    distinct = asking.select("entry").distinct()
    n_entries, n_queries = index.count(), distinct.count()
    blocks = max(1, math.ceil(n_entries / BLOCK_ROWS))
    lots = max(1, math.ceil(n_queries / QUERY_ROWS))

    def dealt(n: int) -> Column:
        return F.pmod(F.xxhash64("entry"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = (
        index.join(distinct, "entry", "left_semi")
        .select(
            F.col("entry").alias("asker"),
            F.col("size").alias("q_size"),
            F.col("vector").alias("v"),
            dealt(lots).alias("q_lot"),
            every(blocks).alias("q_block"),
        )
    )
    blocked = index.withColumn("block", dealt(blocks)).withColumn("lot", every(lots))
    close = (
        blocked.groupBy("size", "block", "lot")
        .cogroup(queries.groupBy("q_size", "q_block", "q_lot"))
        .applyInArrow(_search(found, k), "entry long, score double, found long")
    )
    by_score = Window.partitionBy("entry").orderBy("score", "found")
    best = close.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= k + 1)
    ranked = (
        asking.join(best.drop("n"), "entry")
        .filter(F.col("found") != F.col("vec_id"))
        .withColumn(
            "rank",
            F.row_number().over(Window.partitionBy("vec_id", "entry").orderBy("score", "found")),
        )
        .filter(F.col("rank") <= k)
    )
    return ranked.select(
        F.col("vec_id").alias("query_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("found").alias("vec_id"),
        "score",
    )
