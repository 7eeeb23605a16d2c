"""Hard negatives: windows of inner products searched in STR-packed R-trees.

Rows are sorted by label, vector and id over the whole cluster, so each task holds a tile of
neighbours, which it packs into R-trees of TREE_ROWS: tiles again, by one component after the
other (sort-tile-recursive), down to leaves of LEAF_ROWS, and boxes of FANOUT boxes above them.
A box knows the least and greatest value of each component and of the label. With a query's
vector these give an interval for the inner product with anything inside the box.

A search looks for each query's `count` highest products within its window, among rows of its
label, or of others. It holds a queue of boxes, the highest upper bound first, for a block of queries at a
time; a box is opened for those queries only whose window its interval meets, whose labels
it can hold, and whose list it can still enter: boxes strictly below a full list's last entry
are pruned, those equal to it may hold a smaller id.

The first search finds each anchor's positives, the second the negatives within the window of
each positive's score. Trees and blocks of queries are dealt to the cells of a grid, in which each
query block meets each tree once; what is shuffled grows with the root of the number of cells.

Components are floor(256 * x) with x as double. Rows without an id or a label, with a null or
empty vector, or with a component that is null or not finite (256-fold, too) take no part. Vectors of
different lengths are not compared. Repeated rows count once; rows of one id that differ are
rows each, but not for each other, and the least of them (label, then vector) is the anchor.
Products beyond the range of long are its limits. Ties go to the smaller id. Empty tables give
no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattledger.llm.blocks import every, grid, usable
from wattledger.llm.stored import stored
from wattledger.llm.workers import map_batches

FACTOR = 256
LEAF_ROWS, FANOUT, TREE_ROWS = 64, 8, 4096
QUERY_ROWS = 128
#: Lists that a task holds before it hands them on.
HELD_LISTS = 50_000

LOWEST, HIGHEST = -(2**63), 2**63 - 1
#: Up to here doubles are exact whole numbers.
EXACT = 2.0**53

TREE_SCHEMA = "cell int, dim int, ids binary, labels binary, numbers binary, levels array<binary>"
QUERY_SCHEMA = (
    "cell int, dim int, q_ids binary, q_labels binary, q_numbers binary, q_windows binary"
)


def _floor(number: Column) -> Column:
    """Largest whole number that is not greater, as double; from 2**52 on every double is whole."""
    return F.when(F.abs(number) < 2.0**52, F.floor(number).cast("double")).otherwise(number)


def usable_rows(vectors: DataFrame, label: Column, vector: str) -> DataFrame:
    """vec_id, label, vector (floor(256 * x) of each component) of the rows that take part."""
    whole = F.transform(F.col(vector).cast("array<double>"), lambda x: _floor(x * FACTOR))
    return (
        vectors.where(F.col("vec_id").isNotNull() & usable(F.col(vector)))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            label.cast("long").alias("label"),
            whole.alias("vector"),
        )
        .where(F.col("label").isNotNull() & usable(F.col("vector")))
    )


def str_order(numbers: np.ndarray, rows: np.ndarray, by: list[int]) -> list[np.ndarray]:
    """The rows in leaves of at most LEAF_ROWS: sorted by the first component of `by`, cut into
    slabs of whole leaves, and each slab again by the next one."""
    leaves = -(-len(rows) // LEAF_ROWS)
    if leaves <= 1:
        return [rows] if len(rows) else []
    rows = rows[np.argsort(numbers[rows, by[0]], kind="stable")]
    if len(by) == 1:
        slab = LEAF_ROWS
        return [rows[k : k + slab] for k in range(0, len(rows), slab)]
    slabs = max(2, round(leaves ** (1 / len(by))))
    size = -(-leaves // slabs) * LEAF_ROWS
    return [
        leaf
        for k in range(0, len(rows), size)
        for leaf in str_order(numbers, rows[k : k + size], by[1:])
    ]


class Tree:
    """An R-tree: rows in the order of its leaves; levels of boxes from the leaves up to one box,
    each an array of (least, greatest) by box and coordinate, the label last."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray):
        # Twice two halves tell more than four quarters, so few components of wide spread are used.
        depth = max(1, int(np.log2(max(1, len(ids) // LEAF_ROWS))))
        by = np.argsort(-numbers.std(axis=0), kind="stable")[:depth].tolist()
        leaves = str_order(numbers, np.arange(len(ids)), by)
        order = np.concatenate(leaves)
        # Leaves are full but for some, whose places the bounds name.
        self.bounds = np.concatenate([[0], np.cumsum([len(leaf) for leaf in leaves])])
        self.ids, self.labels, self.numbers = ids[order], labels[order], numbers[order]
        sides = np.column_stack([self.numbers, self.labels.astype(np.float64)])
        starts = self.bounds[:-1]
        low, high = np.minimum.reduceat(sides, starts), np.maximum.reduceat(sides, starts)
        self.levels = [np.stack([low, high])]
        while self.levels[-1].shape[1] > 1:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), FANOUT)
            self.levels.append(
                np.stack([np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)])
            )

    def row(self, cell: int) -> dict:
        return {
            "cell": cell,
            "dim": self.numbers.shape[1],
            "ids": self.ids.tobytes(),
            "labels": self.labels.tobytes(),
            "numbers": self.numbers.tobytes(),
            "levels": [self.bounds.astype(np.int64).tobytes(), *[x.tobytes() for x in self.levels]],
        }

    @classmethod
    def read(cls, row: dict) -> Tree:
        tree, dim = cls.__new__(cls), row["dim"]
        tree.ids, tree.labels = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "labels"))
        tree.numbers = np.frombuffer(row["numbers"]).reshape(-1, dim)
        tree.bounds = np.frombuffer(row["levels"][0], dtype=np.int64)
        tree.levels = [np.frombuffer(x).reshape(2, -1, dim + 1) for x in row["levels"][1:]]
        return tree


class Queries:
    """A block of queries: ids, label, vector, window (least and greatest product wanted)."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.ids, self.labels = (np.frombuffer(row[c], dtype=np.int64) for c in ("q_ids", "q_labels"))
        self.numbers = np.frombuffer(row["q_numbers"]).reshape(-1, dim)
        self.windows = np.frombuffer(row["q_windows"], dtype=np.int64).reshape(-1, 3)
        self.low = _below(self.windows[:, 0].astype(np.float64))
        self.high = _above(self.windows[:, 1].astype(np.float64))
        self.up, self.down = np.maximum(self.numbers, 0), np.minimum(self.numbers, 0)

    def keys(self) -> list[tuple[int, int]]:
        """A list's key: the anchor, and the number that tells its windows apart."""
        return list(zip(self.ids.tolist(), self.windows[:, 2].tolist()))


def _below(bound: np.ndarray) -> np.ndarray:
    """Where doubles round, a number surely not above what the bound stands for."""
    return bound - np.where(np.abs(bound) < EXACT, 0, np.abs(bound) * 1e-12)


def _above(bound: np.ndarray) -> np.ndarray:
    return bound + np.where(np.abs(bound) < EXACT, 0, np.abs(bound) * 1e-12)


def intervals(queries: Queries, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query with anything in each box: the sums of the
    intervals of the single components' products."""
    low, high = boxes[0, :, :-1], boxes[1, :, :-1]
    with np.errstate(over="ignore", invalid="ignore"):
        least = queries.up @ low.T + queries.down @ high.T
        greatest = queries.up @ high.T + queries.down @ low.T
        # Sums round by the size of their parts, whatever is left of them.
        size = np.abs(queries.numbers) @ np.maximum(np.abs(low), np.abs(high)).T
        slack = np.where(size < EXACT, 0, size * 1e-12)
        least, greatest = least - slack, greatest + slack
    return np.nan_to_num(least, nan=-np.inf), np.nan_to_num(greatest, nan=np.inf)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products as longs, cut to the range of long."""
    dim = queries.shape[1]
    if np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * dim < EXACT:
        return (queries @ rows.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], dtype=object) @ np.array(
        [[int(x) for x in row] for row in rows], dtype=object
    ).T
    return np.array([[min(max(x, LOWEST), HIGHEST) for x in row] for row in exact], dtype=np.int64)


class Lists:
    """The best entries of each query met so far: a heap of (product, negative id)."""

    def __init__(self, count: int):
        self.count = count
        self.heaps: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def last(self, key: tuple[int, int]) -> float:
        """A number that a product must reach to enter the list."""
        heap = self.heaps.get(key, ())
        return float(_below(np.float64(heap[0][0]))) if len(heap) == self.count else -np.inf

    def add(self, key: tuple[int, int], entries: list[tuple[int, int]]) -> None:
        heap = self.heaps.setdefault(key, [])
        for entry in entries:
            if len(heap) < self.count:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)

    def batch(self) -> pa.RecordBatch:
        rows = [(*key, -minus, s) for key, heap in self.heaps.items() for s, minus in heap]
        self.heaps = {}
        names = ["anchor_id", "window", "vec_id", "score"]
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def search(tree: Tree, queries: Queries, same_label: bool, lists: Lists) -> int:
    """Enters the tree's rows into the queries' lists, best box first; how many leaves it opened."""
    keys = queries.keys()
    last = np.array([lists.last(key) for key in keys])

    def wanted(least, greatest, sides) -> np.ndarray:
        label_low, label_high = sides[0, -1], sides[1, -1]
        own = queries.labels.astype(np.float64)
        if same_label:
            fits = (label_low <= own) & (own <= label_high)
        else:
            fits = ~((label_low == own) & (label_high == own))
        # Labels beyond what doubles hold are told apart row by row.
        fits |= np.abs(own) >= EXACT
        return fits & (greatest >= queries.low) & (least <= queries.high) & (greatest >= last)

    top = len(tree.levels) - 1
    queue: list[tuple] = []

    def push(level: int, first: int, stop: int, of: np.ndarray) -> None:
        boxes = tree.levels[level][:, first:stop]
        least, greatest = intervals(queries, boxes)
        for k in range(stop - first):
            open_for = of & wanted(least[:, k], greatest[:, k], boxes[:, k])
            if open_for.any():
                entry = (level, first + k, least[:, k], greatest[:, k], open_for)
                heapq.heappush(queue, (-greatest[open_for, k].max(), len(tree.ids) * level + first + k, entry))

    push(top, 0, 1, np.ones(len(keys), dtype=bool))
    opened = 0
    while queue:
        _, _, (level, box, least, greatest, of) = heapq.heappop(queue)
        of = of & wanted(least, greatest, tree.levels[level][:, box])
        if not of.any():
            continue
        if level:
            below = tree.levels[level - 1].shape[1]
            push(level - 1, box * FANOUT, min((box + 1) * FANOUT, below), of)
            continue
        opened += 1
        _open_leaf(tree, box, queries, np.flatnonzero(of), same_label, lists, keys, last)
    return opened


def _open_leaf(tree, box, queries, asking, same_label, lists, keys, last) -> None:
    rows = slice(tree.bounds[box], tree.bounds[box + 1])
    ids, labels = tree.ids[rows], tree.labels[rows]
    found = products(queries.numbers[asking], tree.numbers[rows])
    fits = (queries.labels[asking][:, None] == labels) == same_label
    fits &= queries.ids[asking][:, None] != ids
    window = queries.windows[asking]
    fits &= (found >= window[:, :1]) & (found <= window[:, 1:2])
    fits &= found >= last[asking][:, None]
    for k in np.flatnonzero(fits.any(axis=1)):
        at = np.flatnonzero(fits[k])
        entries = heapq.nlargest(lists.count, zip(found[k, at].tolist(), (-ids[at]).tolist()))
        key = keys[asking[k]]
        lists.add(key, entries)
        last[asking[k]] = lists.last(key)


def pack_trees(rows: DataFrame) -> DataFrame:
    """vec_id, label, vector -> R-trees, by tiles of the whole table. Repeated rows stand side by
    side in a tile and are packed once."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        before = None

        def tree(dim: int) -> pa.RecordBatch:
            ids, labels, vectors = zip(*held.pop(dim))
            made = Tree(np.array(ids, np.int64), np.array(labels, np.int64), np.stack(vectors))
            # Trees are dealt to the columns of the grid by a hash of their first row's id.
            return pa.RecordBatch.from_pylist([made.row(int(ids[0]))], _tree_schema())

        for batch in batches:
            lists = batch.column("vector")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            ids, labels = (batch.column(c).to_pylist() for c in ("vec_id", "label"))
            for k, vec_id in enumerate(ids):
                vector = flat[ends[k] : ends[k + 1]]
                row = (vec_id, labels[k], vector.tobytes())
                if row == before:
                    continue
                before = row
                waiting = held.setdefault(len(vector), [])
                waiting.append((vec_id, labels[k], vector))
                if len(waiting) == TREE_ROWS:
                    yield tree(len(vector))
        for dim in list(held):
            yield tree(dim)

    order = ["label", "vector", "vec_id"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return map_batches(ordered, packed, TREE_SCHEMA.replace("cell int", "cell long"))


def _tree_schema() -> pa.Schema:
    return pa.schema(
        [("cell", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
         ("numbers", pa.binary()), ("levels", pa.list_(pa.binary()))]
    )


def pack_queries(asking: DataFrame) -> DataFrame:
    """anchor_id, window, low, high, label, vector -> blocks of QUERY_ROWS queries."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}

        def block(dim: int) -> pa.RecordBatch:
            rows = held.pop(dim)
            windows = [(r["low"], r["high"], r["window"]) for r in rows]
            return pa.RecordBatch.from_pydict(
                {
                    "cell": pa.array([rows[0]["anchor_id"]], pa.int64()),
                    "dim": pa.array([dim], pa.int32()),
                    "q_ids": [np.array([r["anchor_id"] for r in rows], np.int64).tobytes()],
                    "q_labels": [np.array([r["label"] for r in rows], np.int64).tobytes()],
                    "q_numbers": [np.array([r["vector"] for r in rows], np.float64).tobytes()],
                    "q_windows": [np.array(windows, np.int64).tobytes()],
                }
            )

        for batch in batches:
            for row in batch.to_pylist():
                waiting = held.setdefault(len(row["vector"]), [])
                waiting.append(row)
                if len(waiting) == QUERY_ROWS:
                    yield block(len(row["vector"]))
        for dim in list(held):
            yield block(dim)

    read = asking.select("anchor_id", "window", "low", "high", "label", "vector")
    return map_batches(read, packed, QUERY_SCHEMA.replace("cell int", "cell long"))


def best_products(trees: DataFrame, queries: DataFrame, count: int, same_label: bool) -> DataFrame:
    """anchor_id, window, vec_id, score: each query's `count` best entries, ranked. trees and
    queries: stored tables of pack_trees and pack_queries."""
    cells = int(trees.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = [
        table.agg(F.sum(F.octet_length(ids)) / 8).first()[0] or 0
        for table, ids in ((trees, "ids"), (queries, "q_ids"))
    ]
    columns, rows = grid(cells, *held)
    dealt_trees = trees.withColumn("row", every(rows)).withColumn(
        "cell", F.col("row") * columns + F.pmod(F.xxhash64("cell"), F.lit(columns))
    )
    dealt_queries = queries.withColumn("column", every(columns)).withColumn(
        "cell", F.pmod(F.xxhash64("cell"), F.lit(rows)) * columns + F.col("column")
    )
    # Shuffled: Spark would estimate the copies without their number, and broadcast them.
    pairs = dealt_queries.drop("column").join(dealt_trees.drop("row").hint("merge"), ["cell", "dim"])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(count)
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                search(Tree.read(row), Queries(row), same_label, lists)
                if len(lists.heaps) >= HELD_LISTS:
                    yield lists.batch()
        if lists.heaps:
            yield lists.batch()

    entries = map_batches(pairs, found, "anchor_id long, window long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: for
    each of an anchor's `positives` highest rows of its label, the `negatives` highest rows of
    other labels whose product is from `low` to `high` percent of the positive's. is_anchor: a
    condition on vec_id; label: a whole number."""
    rows = usable_rows(vectors, F.col(label) if isinstance(label, str) else label, vector)
    trees = stored(pack_trees(rows), "trees")
    anchors = stored(
        rows.where(is_anchor)
        .groupBy(F.col("vec_id").alias("anchor_id"))
        .agg(F.min(F.struct("label", "vector")).alias("own"))
        .select("anchor_id", "own.label", "own.vector"),
        "anchors",
    )
    everything = anchors.select(
        "*", F.lit(0).cast("long").alias("window"),
        F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"),
    )
    positive = stored(
        best_products(trees, stored(pack_queries(everything), "queries"), positives, True).select(
            "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "positives",
    )
    # The whole numbers n with low * p <= 100 * n <= high * p.
    score = F.col("positive_score").cast("decimal(20,0)")
    least = F.ceil(score * F.lit(low).cast("decimal(6,0)") / F.lit(100).cast("decimal(3,0)"))
    most = F.floor(score * F.lit(high).cast("decimal(6,0)") / F.lit(100).cast("decimal(3,0)"))

    def cut(bound: Column) -> Column:
        limits = [F.lit(limit).cast("decimal(20,0)") for limit in (LOWEST, HIGHEST)]
        return F.least(F.greatest(bound.cast("decimal(30,0)"), limits[0]), limits[1]).cast("long")

    windows = (
        positive.select("anchor_id", "positive_score")
        .distinct()
        .select("anchor_id", F.col("positive_score").alias("window"), cut(least).alias("low"),
                cut(most).alias("high"))
        .where(F.col("low") <= F.col("high"))
        .join(anchors.hint("merge"), "anchor_id")
    )
    negative = best_products(trees, stored(pack_queries(windows), "queries"), negatives, False)
    return positive.join(
        negative.select(
            "anchor_id",
            F.col("window").alias("positive_score"),
            "rank",
            F.col("vec_id").alias("negative_id"),
            F.col("score").alias("negative_score"),
        ).hint("merge"),
        ["anchor_id", "positive_score"],
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
