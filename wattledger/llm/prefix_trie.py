"""Trie of conversation prefixes: range minima over the common prefixes of sorted conversations.

A conversation is rebuilt from the first turns of its group's first conversation and its own
later ones, and written as one cell a turn: 16 bytes of the SHA-256 digest of role and text, 4
bytes of the text's length. So texts are shuffled never, and sorted cells are sorted
conversations, in which the members of a prefix stand side by side.

1. Rebuilt conversations are sorted by cells and id over the whole cluster, and cut into
   blocks of some thousand. Equal ones in a row are one run; a run's ids are at most RUN_IDS.
2. Within a block, a sparse table holds minima over the lengths of the prefixes that neighbours
   have in common. Every candidate prefix (of a run's whole length, or of what it has in common
   with its neighbour) searches its left and right extents in the table by halving steps, all
   candidates at once and each for itself; there is no stack. An interval's members, leaves and
   tokens are differences of running sums.
3. Only prefixes that go on in the neighbouring block are merged by their digest, across
   blocks: at most two of each depth a block. Their sums go back to the blocks, which then
   return each node once, from the block that has the first of its members.

Ids of a class of equal conversations are digested in order, as lists of RUN_IDS: SHA-256 has no
parallel form, so the lists of one class go through one task, as a stream.

Turns are ordered by turn (null first), those of one turn by their cells; null role or text is
empty. Rows without a conv_id take no part. Repeated rows are repeated turns. A conversation is
one value: its cells, 20 bytes a turn, must fit a row. Empty tables give no rows. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattledger.llm.stored import stored
from wattledger.llm.workers import map_batches

CELL = 20
#: Conversations of a group start like its first one; so many turns at most, less one.
GROUP, MOST_SHARED = 5, 9
#: Runs and bytes of a block, ids of a run.
BLOCK_RUNS, BLOCK_BYTES, RUN_IDS = 4096, 1 << 20, 4096

NO_IDS = hashlib.sha256(b"").hexdigest()

BLOCK_SCHEMA = (
    "partition int, block int, cells array<binary>, counts array<long>, lows array<long>,"
    " ends array<string>, runs array<struct<digest: binary, low: long, ids: string>>,"
    " before int, after int, first binary, last binary"
)
PARTIAL_SCHEMA = (
    "digest binary, partition int, block int, depth int, left boolean, right boolean,"
    " n_convs long, low long, n_children long, n_leaves long, saved long"
)
NODE_SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string"
)


def _cell() -> Column:
    """A turn as hexadecimal digits of its cell."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(
        F.substring(F.sha2(F.encode(whole, "UTF-8"), 256), 1, 2 * CELL - 8),
        F.lpad(F.hex(F.octet_length(text)), 8, "0"),
    )


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its group."""
    return (F.crc32(F.encode(conv_id.cast("string"), "UTF-8")) % MOST_SHARED).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, cells (binary): every conversation of turns (conv_id, turn, role, text) as its
    group's first turns and its own later ones."""
    conv_id = F.col("conv_id")
    own = (
        turns.where(conv_id.isNotNull())
        .select(
            conv_id.cast("long").alias("conv_id"),
            (conv_id - conv_id % GROUP).cast("long").alias("base"),
            F.struct("turn", _cell().alias("cell")).alias("turn"),
        )
        # One shuffle serves both: a conversation, and its group.
        .repartition("base")
        .groupBy("base", "conv_id")
        .agg(F.array_sort(F.collect_list("turn")).alias("turns"))
        .select("base", "conv_id", F.col("turns.cell").alias("own"))
    )
    first = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, MOST_SHARED - 1)))
    shared = shared_turns(F.col("conv_id"))
    return (
        own.withColumn("head", first.over(Window.partitionBy("base")))
        .select(
            "conv_id",
            F.concat(
                F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), shared),
                F.slice("own", shared + 1, F.greatest(F.size("own") - shared, F.lit(0))),
            ).alias("cells"),
        )
        .select("conv_id", F.unhex(F.array_join("cells", "")).alias("cells"))
    )


def common_cells(left: bytes, right: bytes) -> int:
    """How many cells two conversations have in common from their starts."""
    size = min(len(left), len(right))
    if left[:size] == right[:size]:
        return size // CELL
    a, b = (np.frombuffer(x, dtype=np.uint8, count=size) for x in (left, right))
    return int((a != b).argmax()) // CELL


def _digest(cells: bytes) -> bytes:
    return hashlib.blake2b(cells, digest_size=16).digest()


class _Packer:
    """Sorted (cells, conv_id) to blocks; a block waits until its successor's start is known."""

    def __init__(self, partition: int):
        self.partition, self.number, self.before = partition, 0, None
        self.runs: list[list] = []
        self.bytes = 0

    def add(self, cells: bytes, conv_id: int) -> dict | None:
        run = self.runs[-1] if self.runs else None
        if run and run[0] == cells and len(run[1]) < RUN_IDS:
            run[1].append(conv_id)
            self.bytes += 8
            return None
        full = len(self.runs) >= BLOCK_RUNS or self.bytes >= BLOCK_BYTES
        out = self.block(cells) if full else None
        self.runs.append([cells, [conv_id]])
        self.bytes += len(cells) + 8
        return out

    def block(self, following: bytes | None) -> dict:
        runs = self.runs
        cells = [run[0] for run in runs]
        after = None if following is None else common_cells(cells[-1], following)
        # Whole classes: neither they nor their neighbours may go on outside this block.
        first_whole = self.before is not None and self.before != cells[0]
        last_whole = following is not None and following != cells[-1]
        ends, open_runs = [], []
        for k, (own, ids) in enumerate(runs):
            whole = (cells[k - 1] != own if k else first_whole) and (
                cells[k + 1] != own if k + 1 < len(runs) else last_whole
            )
            listed = ",".join(map(str, ids))
            ends.append(hashlib.sha256(listed.encode()).hexdigest() if whole else None)
            if not whole:
                open_runs.append({"digest": _digest(own), "low": ids[0], "ids": listed})
        out = {
            "partition": self.partition,
            "block": self.number,
            "cells": cells,
            "counts": [len(run[1]) for run in runs],
            "lows": [run[1][0] for run in runs],
            "ends": ends,
            "runs": open_runs,
            "before": None if self.before is None else common_cells(self.before, cells[0]),
            "after": after,
            "first": cells[0] if self.before is None else None,
            "last": cells[-1] if following is None else None,
        }
        self.number, self.before, self.runs, self.bytes = self.number + 1, cells[-1], [], 0
        return out


def _arrow(schema: str) -> pa.Schema:
    """An Arrow schema of a few plain column types."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(),
             "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary()),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    run = pa.struct([("digest", pa.binary()), ("low", pa.int64()), ("ids", pa.string())])
    runs = "runs array<struct<digest: binary, low: long, ids: string>>"
    fields = schema.replace(runs, "runs runs").split(", ")
    kinds["runs"] = pa.list_(run)
    return pa.schema([tuple([f.split(" ")[0], kinds[f.split(" ")[1]]]) for f in fields])


def blocks(conversations: DataFrame) -> DataFrame:
    """Sorted runs in blocks, each with how many cells its ends have in common with the blocks
    before and after it (-1: there is none)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(BLOCK_SCHEMA)
        packer = _Packer(TaskContext.get().partitionId())
        for batch in batches:
            for cells, conv_id in zip(
                batch.column("cells").to_pylist(), batch.column("conv_id").to_pylist()
            ):
                done = packer.add(cells, conv_id)
                if done:
                    yield pa.RecordBatch.from_pylist([done], schema)
        if packer.runs:
            yield pa.RecordBatch.from_pylist([packer.block(None)], schema)

    ordered = conversations.repartitionByRange("cells", "conv_id").sortWithinPartitions(
        "cells", "conv_id"
    )
    packed = stored(map_batches(ordered, pack, BLOCK_SCHEMA), "blocks")

    # The ends of each partition beside its neighbours': one row a partition.
    order = Window.orderBy("partition")
    neighbours = (
        packed.groupBy("partition")
        .agg(F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last"))
        .select(
            "partition", "first", "last",
            F.lag("last").over(order).alias("previous"), F.lead("first").over(order).alias("next"),
        )
    )

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pydict(
                {
                    "partition": batch.column("partition"),
                    "from_previous": pa.array(
                        [-1 if r["previous"] is None else common_cells(r["previous"], r["first"])
                         for r in rows], pa.int32()),
                    "to_next": pa.array(
                        [-1 if r["next"] is None else common_cells(r["last"], r["next"])
                         for r in rows], pa.int32()),
                }
            )

    # Three numbers a partition: small enough for every worker.
    edges = map_batches(neighbours, common, "partition int, from_previous int, to_next int")
    return packed.join(F.broadcast(stored(edges, "edges")), "partition").select(
        "partition", "block", "cells", "counts", "lows", "ends", "runs",
        F.coalesce("before", "from_previous").alias("before"),
        F.coalesce("after", "to_next").alias("after"),
    )


class SparseTable:
    """Minima of every 2**k values in a row."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        width = 1
        while 2 * width <= len(values):
            row = self.rows[-1]
            self.rows.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The minimum of values[first..last], first <= last."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), dtype=self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[first[at]], row[last[at] - (1 << int(k)) + 1])
        return out


def extents(common: SparseTable, count: int, place: np.ndarray, depth: np.ndarray):
    """First and last of the neighbours around each place that share `depth` cells with it.
    common: over common[k], what k has in common with k - 1, for k from 1 on (entry 0 unused)."""
    left, right = place.copy(), place.copy()
    for k in range(len(common.rows) - 1, -1, -1):
        row, width = common.rows[k], 1 << k
        start = np.maximum(left - width + 1, 0)
        left[(left - width >= 0) & (row[np.minimum(start, len(row) - 1)] >= depth)] -= width
        start = np.minimum(right + 1, len(row) - 1)
        right[(right + width < count) & (row[start] >= depth)] += width
    return left, right


class Nodes:
    """The trie nodes with members in one block, as arrays: first and last run, depth, and what
    the block's own runs add to n_convs, low, n_children, n_leaves and saved. A child or a text
    counts where its first member is."""

    def __init__(self, cells: list[bytes], counts, lows, before: int, after: int):
        n = len(cells)
        self.cells, self.before, self.after, self.count = cells, before, after, n
        counts, lows = np.asarray(counts, np.int64), np.asarray(lows, np.int64)
        length = np.array([len(own) // CELL for own in cells], dtype=np.int64)
        common = np.full(n + 1, -1, dtype=np.int64)
        for k in range(1, n):
            common[k] = common_cells(cells[k - 1], cells[k])

        # Bytes of text up to each turn of each run.
        flat = np.frombuffer(b"".join(cells), dtype=np.uint8).reshape(-1, CELL)
        sizes = np.ascontiguousarray(flat[:, CELL - 4 :]).view(">u4").ravel().astype(np.int64)
        running = np.concatenate([[0], np.cumsum(sizes)])
        offset = np.concatenate([[0], np.cumsum(length)])

        def upto(run, depth):
            return running[offset[run] + depth] - running[offset[run]]

        every = np.arange(n)
        total = upto(every, length)
        known = np.maximum(common[:n], 0)
        known[0] = max(before, 0)
        new = total - upto(every, np.minimum(known, length))
        following = np.append(common[1:n], after)
        leaf = (following < length).astype(np.int64)

        # Candidate prefixes: each run whole, and what it has in common with the run before.
        place = np.concatenate([every, every[1:]])
        depth = np.concatenate([length, common[1:n]])
        branches = np.concatenate([np.zeros(n, np.int64), (length[1:] > common[1:n])])
        table = SparseTable(common[:n])
        first, last = extents(table, n, place, depth)
        _, one, which = np.unique(first * n + last, return_index=True, return_inverse=True)
        branched = np.bincount(which.ravel(), weights=branches).astype(np.int64)
        first, last, deepest = first[one], last[one], depth[one]
        # An interval is a node of every depth down from what its members share with others.
        above = np.maximum(np.where(first > 0, common[first], -1), common[last + 1])
        each = deepest - above
        kind = np.repeat(np.arange(len(first)), each)
        step = np.arange(len(kind)) - np.repeat(np.cumsum(each) - each, each)
        self.depth = above[kind] + 1 + step
        self.first, self.last, self.kind = first[kind], last[kind], kind
        self.length = length

        def total_of(values):
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[self.last + 1] - sums[self.first]

        self.n_convs = total_of(counts)
        self.low = SparseTable(lows).least(self.first, self.last)
        self.n_leaves = total_of(leaf)
        starts_block = self.first == 0
        goes_on = length[self.first] > self.depth
        known_child = starts_block & (before > self.depth)
        lowest = self.depth == deepest[kind]
        self.n_children = np.where(lowest, branched[kind], 0) + (goes_on & ~known_child)
        shared = upto(self.first, np.maximum(self.depth - 1, 0))
        seen = np.maximum(self.depth - 1, np.where(starts_block, max(before, 0), 0))
        seen = np.minimum(np.maximum(seen, 0), length[self.first])
        texts = total_of(new) - new[self.first] + total[self.first] - upto(self.first, seen)
        self.saved = total_of(counts * total) - shared * self.n_convs - texts
        self.left = starts_block & (self.depth <= before)
        self.right = (self.last == n - 1) & (self.depth <= after)

    def chain_digests(self, run: int, deepest: int) -> list[bytes]:
        """Digests of a run's prefixes of 0 to `deepest` cells."""
        state = hashlib.blake2b(digest_size=16)
        out = [state.digest()]
        for k in range(deepest):
            state.update(self.cells[run][k * CELL : (k + 1) * CELL])
            out.append(state.copy().digest())
        return out


def _nodes_of(row: dict) -> Nodes:
    return Nodes(row["cells"], row["counts"], row["lows"], row["before"], row["after"])


def _partials(packed: DataFrame) -> DataFrame:
    """What each block adds to the nodes that go on in a neighbouring block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(PARTIAL_SCHEMA)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                nodes = _nodes_of(row)
                at = np.flatnonzero(nodes.left | nodes.right)
                digests = {
                    True: nodes.chain_digests(0, max(row["before"], 0)),
                    False: nodes.chain_digests(nodes.count - 1, max(row["after"], 0)),
                }
                depth, left = nodes.depth[at], nodes.left[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digests[bool(a)][d] for a, d in zip(left, depth)], pa.binary()),
                        pa.array(np.full(len(at), row["partition"]), pa.int32()),
                        pa.array(np.full(len(at), row["block"]), pa.int32()),
                        pa.array(depth, pa.int32()),
                        pa.array(left),
                        pa.array(nodes.right[at]),
                        *[
                            pa.array(getattr(nodes, name)[at], pa.int64())
                            for name in ("n_convs", "low", "n_children", "n_leaves", "saved")
                        ],
                    ],
                    schema=schema,
                )

    read = packed.select("partition", "block", "cells", "counts", "lows", "before", "after")
    return map_batches(read, cut, PARTIAL_SCHEMA)


def _open_ends(packed: DataFrame) -> DataFrame:
    """digest, partition, block (of the first run), ends: SHA-256 of the ids of the classes that
    may have runs in several places."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        done: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*done)) or [()] * 4
            kinds = (pa.binary(), pa.int32(), pa.int32(), pa.string())
            names = ["digest", "partition", "block", "ends"]
            out = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(out, names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if own is None or own[0] != row["digest"]:
                    if own is not None:
                        done.append((*own, state.hexdigest()))
                    own = (row["digest"], row["partition"], row["block"])
                    state = hashlib.sha256()
                else:
                    state.update(b",")
                state.update(row["ids"].encode())
            if done:
                yield batch_of()
        if own is not None:
            done.append((*own, state.hexdigest()))
            yield batch_of()

    runs = packed.select("partition", "block", F.explode("runs").alias("run")).select(
        "run.digest", "run.low", "run.ids", "partition", "block"
    )
    ordered = runs.repartition("digest").sortWithinPartitions("digest", "low")
    return map_batches(ordered, hashed, "digest binary, partition int, block int, ends string")


def trie(conversations: DataFrame) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 of every distinct prefix of conversations (conv_id, cells); one row
    for each id."""
    packed = blocks(conversations)
    partials = stored(_partials(packed), "partials")
    merged = partials.groupBy("digest").agg(
        F.sum("n_convs").alias("n_convs"),
        F.min("low").alias("low"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
    )
    facts = ["n_convs", "low", "n_children", "n_leaves", "saved"]
    back = (
        partials.drop(*facts)
        .join(merged, "digest")
        .groupBy("partition", "block")
        .agg(F.collect_list(F.struct("depth", "left", "right", *facts)).alias("chain"))
    )
    ends = (
        _open_ends(packed)
        .groupBy("partition", "block")
        .agg(F.collect_list(F.struct("digest", "ends")).alias("open_ends"))
    )
    place = ["partition", "block"]
    whole = (
        packed.drop("runs")
        .join(stored(back, "chains"), place, "left")
        .join(stored(ends, "ends"), place, "left")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(NODE_SCHEMA)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                yield _finished(row, schema)

    return map_batches(whole, finish, NODE_SCHEMA)


def _finished(row: dict, schema: pa.Schema) -> pa.RecordBatch:
    """A block's nodes: those whose first member it has."""
    nodes = _nodes_of(row)
    facts = {name: getattr(nodes, name).copy()
             for name in ("n_convs", "low", "n_children", "n_leaves", "saved")}
    chain = row["chain"] or []
    merged = {
        side: {entry["depth"]: entry for entry in chain if entry[side]}
        for side in ("left", "right")
    }
    for side in ("left", "right"):
        for at in np.flatnonzero(getattr(nodes, side)):
            entry = merged[side][int(nodes.depth[at])]
            for name, values in facts.items():
                values[at] = entry[name]
    # A node's parent is the node one less deep around its first member.
    key = nodes.depth * nodes.count + nodes.first
    order = np.argsort(key)
    kept = np.flatnonzero(~nodes.left)
    around = np.searchsorted(key[order], key[kept] - nodes.count, side="right") - 1
    parent = order[np.maximum(around, 0)]
    rootless = nodes.depth[kept] == 0
    open_ends = {entry["digest"]: entry["ends"] for entry in row["open_ends"] or []}
    ends = []
    for a in kept:
        run = int(nodes.first[a])
        if nodes.length[run] != nodes.depth[a]:
            ends.append(NO_IDS)
        else:
            ends.append(row["ends"][run] or open_ends[_digest(row["cells"][run])])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(facts["low"][kept], pa.int64()),
            pa.array(nodes.depth[kept], pa.int64()),
            pa.array(facts["low"][parent], pa.int64(), mask=rootless),
            pa.array(facts["n_convs"][kept], pa.int64()),
            pa.array(facts["n_children"][kept], pa.int64()),
            pa.array(facts["n_leaves"][kept], pa.int64()),
            pa.array(facts["saved"][kept], pa.int64()),
            pa.array(ends, pa.string()),
        ],
        schema=schema,
    )


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of turns (conv_id, turn, role, text)."""
    return trie(stored(rebuilt(turns), "rebuilt"))
