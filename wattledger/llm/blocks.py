"""Vectors in blocks, and every block of queries beside every block of candidates.

A block is one row: some hundred vectors of one length as packed numbers. Both kinds of blocks
are dealt to the cells of a grid, in which each query block meets each candidate block once: what
is shuffled grows with the root of the number of cells, and no task holds more than two blocks and
its lists. Copies are shuffled, never broadcast: Spark would estimate them without their number.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattledger.llm.workers import map_batches

QUERY_ROWS = 128
CANDIDATE_ROWS = 512

BLOCK_SCHEMA = "dim int, shard int, ids binary, numbers binary, extra binary"


def usable(vector: Column) -> Column:
    """Not null, not empty, every component there and finite."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(
        F.forall(
            vector,
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
        ),
        F.lit(False),
    )


def pack(vectors: DataFrame, rows: int, shards: int) -> DataFrame:
    """vec_id long, vector array<double>, extra double -> blocks of at most `rows` vectors."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, numbers, extra = zip(*held.pop(dim))
            first = np.array(ids, dtype=np.int64)
            return pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "shard": pa.array([int(first[0] * 2654435761 % 2**32) % shards], pa.int32()),
                    "ids": [first.tobytes()],
                    "numbers": [np.stack(numbers).tobytes()],
                    "extra": [np.array(extra, dtype=np.float64).tobytes()],
                }
            )

        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            ids = batch.column("vec_id").to_pylist()
            extra = batch.column("extra").to_pylist()
            for k, vec_id in enumerate(ids):
                numbers = flat[(ends[k - 1] if k else 0) : ends[k]]
                waiting = held.setdefault(len(numbers), [])
                waiting.append((vec_id, numbers, extra[k]))
                if len(waiting) == rows:
                    yield block(len(numbers))
        for dim in list(held):
            yield block(dim)

    return map_batches(vectors.select("vec_id", "vector", "extra"), blocks, BLOCK_SCHEMA)


def ids_of(block: bytes) -> np.ndarray:
    return np.frombuffer(block, dtype=np.int64)


def numbers_of(block: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(block, dtype=np.float64).reshape(-1, dim)


class Best:
    """The best entries of each query met so far: one heap of at most `count` per query, the
    least at its top. Ties go to the smaller id."""

    def __init__(self, count: int):
        self.count = count
        self.heaps: dict[int, list[tuple]] = {}

    def add(self, query: int, entries: list[tuple]) -> None:
        """entries: (score, negative id)."""
        heap = self.heaps.setdefault(query, [])
        for entry in entries:
            if len(heap) < self.count:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)

    def least(self, queries: np.ndarray) -> np.ndarray:
        """A score below which nothing can enter a query's list any more."""
        full = (self.heaps.get(int(q), ()) for q in queries)
        return np.array([h[0][0] if len(h) == self.count else -np.inf for h in full])

    def batch(self, score_type: pa.DataType) -> pa.RecordBatch:
        rows = [(q, -minus, s) for q, heap in self.heaps.items() for s, minus in heap]
        self.heaps = {}
        queries, ids, scores = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(queries, pa.int64()),
                pa.array(ids, pa.int64()),
                pa.array(scores, score_type),
            ],
            names=["query_id", "vec_id", "score"],
        )


#: Queries whose lists one task holds before it hands them on.
HELD_QUERIES = 20_000


def block_join(
    queries: DataFrame,
    candidates: DataFrame,
    shards: int,
    count: int,
    tile: Callable[[dict, dict, Best], None],
    score: str = "double",
) -> DataFrame:
    """query_id, vec_id, score: what `tile` found good in each pair of blocks, at most `count`
    per query, task and HELD_QUERIES queries. tile(query block, candidate block, lists). queries
    and candidates: stored tables of pack(), dealt to about `shards` cells."""
    held = [
        table.agg(F.sum(F.octet_length("ids")) / 8).first()[0] or 0 for table in (candidates, queries)
    ]
    columns, rows = grid(shards, *held)
    asking = queries.withColumn("column", every(columns)).withColumn(
        "cell", F.pmod("shard", F.lit(rows)) * columns + F.col("column")
    )
    asked = candidates.withColumn("row", every(rows)).withColumn(
        "cell", F.col("row") * columns + F.pmod("shard", F.lit(columns))
    )
    parts = ("ids", "numbers", "extra")
    pairs = asking.select("dim", "cell", *[F.col(c).alias(f"q_{c}") for c in parts]).join(
        asked.select("dim", "cell", *parts).hint("merge"), ["dim", "cell"]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, score_type = Best(count), {"double": pa.float64(), "long": pa.int64()}[score]
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                tile(
                    {c: row[f"q_{c}"] for c in ("ids", "numbers", "extra")} | {"dim": row["dim"]},
                    row,
                    best,
                )
                if len(best.heaps) >= HELD_QUERIES:
                    yield best.batch(score_type)
        if best.heaps:
            yield best.batch(score_type)

    return map_batches(pairs, search, f"query_id long, vec_id long, score {score}")


def grid(cells: int, candidates: float, queries: float) -> tuple[int, int]:
    """Columns for the candidates and rows for the queries, about `cells` together, with the
    fewest copies: a block of candidates goes to every row, one of queries to every column."""
    columns = round((cells * max(candidates, 1) / max(queries, 1)) ** 0.5)
    columns = min(max(columns, 1), cells)
    return columns, max(cells // columns, 1)


def every(number: int) -> Column:
    """One row for each of 0 to number - 1."""
    return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))


def ranked(lists: DataFrame, count: int) -> DataFrame:
    """The lists of all tasks merged: the `count` best of each query with their rank. Each
    task cuts its part of a query's entries to `count` before they are shuffled."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
