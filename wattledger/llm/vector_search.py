"""Nearest neighbours by cosine: a block matrix join on 8-bit codes, settled in doubles.

Every vector is scaled to length 1 and rounded to 8-bit codes with a scale of its own; the
length of what rounding took away is kept. The product of two blocks of codes then gives all
cosines of a tile with an error bound for each:

    |cosine - estimate| <= e_c + e_q * (1 + e_c)      e: length of a vector's rounding error

A candidate survives if its highest possible cosine reaches what the k-th best of the tile,
or of the query's list so far, has for certain. Survivors are recomputed from the original
vectors in doubles and go to the query's heap; the heaps of all tasks are merged. The bound
is proven, so the neighbours found are the exact ones.

Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor
do rows without an id; vectors of different lengths are not compared. A query is not compared
with rows of its own id. Repeated candidate rows are candidates each; of several query rows of
one id the smallest vector asks. Ties go to the smaller id. Empty tables give no rows; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm import blocks as B
from wattledger.llm.stored import stored

LEVELS = 127
#: Blocks are told apart by a number below this, by which they are dealt.
DEALT = 1 << 20
#: Allowance for the rounding of the bound's own arithmetic.
SLACK = 1e-9


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two each, so that squares neither overflow nor vanish. The
    cosine is the same to the last bit."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None])


def _dots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in order of the components."""
    total = np.zeros(len(left))
    for k in range(left.shape[1]):
        total += left[:, k] * right[:, k]
    return total


class Coded:
    """A block's vectors with their codes, scales and error lengths."""

    def __init__(self, block: dict):
        self.ids = B.ids_of(block["ids"])
        self.vectors = _scaled(B.numbers_of(block["numbers"], block["dim"]))
        self.norms = np.sqrt(_dots(self.vectors, self.vectors))
        unit = self.vectors / self.norms[:, None]
        self.scales = np.abs(unit).max(axis=1) / LEVELS
        self.codes = np.rint(unit / self.scales[:, None]).astype(np.int8)
        lost = unit - self.codes * self.scales[:, None]
        self.errors = np.sqrt((lost * lost).sum(axis=1))


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Products of 8-bit codes. Single precision holds their sums exactly up to 2**24, which
    is 1040 components; longer vectors take doubles."""
    kind = np.float32 if left.shape[1] * LEVELS * LEVELS < 2**24 else np.float64
    return (left.astype(kind) @ right.astype(kind).T).astype(np.float64)


def nearest(vectors: DataFrame, is_query: Column, count: int = 5, vector: str = "embedding"):
    """query_id, rank (from 1), vec_id, score: the `count` nearest of every row that meets
    is_query (a condition on vec_id), among all rows of vectors (vec_id and `vector`)."""
    shards = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    column = F.col(vector)
    there = vectors.where(F.col("vec_id").isNotNull() & B.usable(column)).where(
        F.exists(column, lambda x: x != 0)
    )
    read = there.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        column.cast("array<double>").alias("vector"),
        F.lit(0.0).alias("extra"),
    )
    asking = read.where(is_query).groupBy("vec_id", "extra").agg(F.min("vector").alias("vector"))

    def tile(query_block: dict, candidate_block: dict, best: B.Best) -> None:
        queries, candidates = Coded(query_block), Coded(candidate_block)
        estimate = _products(queries.codes, candidates.codes)
        estimate *= queries.scales[:, None] * candidates.scales
        bound = candidates.errors + queries.errors[:, None] * (1 + candidates.errors) + SLACK
        same = queries.ids[:, None] == candidates.ids
        sure = np.where(same, -np.inf, estimate - bound)
        if sure.shape[1] > count:
            reached = -np.partition(-sure, count - 1, axis=1)[:, count - 1]
        else:
            reached = np.full(len(sure), -np.inf)
        reached = np.maximum(reached, best.least(queries.ids))
        asked, found = np.nonzero(~same & (estimate + bound >= reached[:, None]))
        scores = _dots(queries.vectors[asked], candidates.vectors[found]) / (
            queries.norms[asked] * candidates.norms[found]
        )
        # A query's survivors, best first; more than `count` of one tile can't be needed.
        order = np.lexsort((candidates.ids[found], -scores, asked))
        asked, found, scores = asked[order], found[order], scores[order]
        begin = np.searchsorted(asked, np.arange(len(queries.ids) + 1))
        for q in range(len(queries.ids)):
            part = slice(begin[q], min(begin[q + 1], begin[q] + count))
            ids = candidates.ids[found[part]].tolist()
            best.add(int(queries.ids[q]), [(s, -i) for s, i in zip(scores[part].tolist(), ids)])

    lists = B.block_join(
        stored(B.pack(asking, B.QUERY_ROWS, DEALT), "queries"),
        stored(B.pack(read, B.CANDIDATE_ROWS, DEALT), "candidates"),
        shards,
        count,
        tile,
    )
    return B.ranked(lists, count).select("query_id", "rank", "vec_id", "score")
