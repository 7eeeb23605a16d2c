"""Exact top-k by inner product: the three-phase uniform threshold.

A vector's components are dealt to NODES parts, and a node is one part of a block of vectors: a
row of its own, which knows its own part of every score and nothing of the others.

1. Gather. Every node lists its LISTED * `count` highest parts of each query, and the lowest one.
   The listed entries' other parts are asked for, and the count-th highest of their scores is a
   cutoff that the true answer reaches; the longer the lists, the nearer it is to the truth.
2. Name. The cutoff goes out with the queries. What a part exceeds its node's lowest by is its
   excess; an entry's score is the sum of its excesses and of the nodes' lowest. Each node
   names, from its own part alone, the entries whose excess reaches its share: what the cutoff
   exceeds the sum of the lowest by, divided by the number of nodes. An entry that no node
   names is below the cutoff, and what a node doesn't name is below that share.
3. Resolve. Named excesses, and the share for those not named, are a bound from above. Only
   entries whose bound reaches the cutoff go on; the parts that are missing, no others, are
   computed from the vectors and added.

Blocks of nodes and of queries are dealt to the cells of a grid, so what is shuffled grows with
the root of the number of cells.

Components are floor(256 * x) with x as double. Vectors that are null, empty or hold a null or
non-finite component take no part, nor do rows without an id; vectors of different lengths
are not compared. A query is not compared with rows of its own id. Repeated candidate rows are
candidates each; of several query rows of one id the smallest vector asks. Ties go to the
smaller id. Scores beyond the range of long are its limits; a node whose parts doubles can't
hold exactly names everything and leaves its parts to the third phase. Empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattledger.llm.blocks import CANDIDATE_ROWS, QUERY_ROWS, every, grid, ranked, usable
from wattledger.llm.stored import stored
from wattledger.llm.workers import map_batches

NODES = 2
#: How many times the entries asked for a node lists in the first phase.
LISTED = 12
FACTOR = 256

LONG_LIMITS = (-(2**63), 2**63 - 1)
#: Stands for a lowest part or a cutoff that isn't known.
UNKNOWN = LONG_LIMITS[0]
#: Up to here doubles are exact whole numbers.
EXACT = 2.0**53
#: Queries whose lists one task holds before it hands them on.
HELD_QUERIES = 20_000

PARTS = "query_id long, node int, row long, vec_id long, part long"


def _bounds(total: Column, node: Column) -> tuple[Column, Column]:
    """First component of a node, and of the one after it, of `total` components."""
    nodes = F.least(F.lit(NODES), total)
    return F.floor(total * node / nodes).cast("int"), F.floor(total * (node + 1) / nodes).cast("int")


def _nodes(vectors: DataFrame) -> DataFrame:
    """The vectors' parts, one row for each node: `total`, `node`, `numbers`."""
    total = F.size("vector")
    parts = vectors.select(
        "*", total.alias("total"), F.explode(F.sequence(F.lit(0), F.least(F.lit(NODES), total) - 1)).alias("node")
    )
    first, last = _bounds(F.col("total"), F.col("node"))
    return parts.withColumn("numbers", F.slice("vector", first + 1, last - first)).drop("vector")


def _pack(parts: DataFrame, longs: list[str], rows: int) -> DataFrame:
    """Blocks of at most `rows` parts of one node and total; longs: columns that go with them."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[tuple]] = {}

        def block(key: tuple[int, int]) -> pa.RecordBatch:
            numbers, *others = zip(*held.pop(key))
            columns = {"total": pa.array([key[0]], pa.int32()), "node": pa.array([key[1]], pa.int32())}
            columns["deal"] = pa.array([others[0][0]], pa.int64())
            columns["numbers"] = [np.stack(numbers).tobytes()]
            for name, values in zip(longs, others):
                columns[name] = [np.array(values, dtype=np.int64).tobytes()]
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            lists = batch.column("numbers")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            columns = [batch.column(c).to_pylist() for c in ("total", "node", *longs)]
            for k, (total, node, *others) in enumerate(zip(*columns)):
                waiting = held.setdefault((total, node), [])
                waiting.append((flat[(ends[k - 1] if k else 0) : ends[k]], *others))
                if len(waiting) == rows:
                    yield block((total, node))
        for key in list(held):
            yield block(key)

    schema = "total int, node int, deal long, numbers binary" + "".join(f", {c} binary" for c in longs)
    return map_batches(parts.select("total", "node", "numbers", *longs), packed, schema)


def _beside(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """Every block of queries beside every block of candidates of its node and total."""
    cells = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = [
        side.agg(F.sum(F.octet_length("numbers"))).first()[0] or 0 for side in (candidates, queries)
    ]
    columns, rows = grid(max(cells // NODES, 1), *sizes)
    asked = queries.withColumn("column", every(columns)).select(
        "total", "node",
        (F.pmod(F.xxhash64("deal"), F.lit(rows)) * columns + F.col("column")).alias("cell"),
        *[F.col(c).alias(f"q_{c}") for c in ("numbers", "vec_id", "lowest", "cutoff")],
    )
    dealt = candidates.withColumn("line", every(rows)).withColumn(
        "cell", F.col("line") * columns + F.pmod(F.xxhash64("deal"), F.lit(columns))
    )
    return asked.join(dealt.drop("line", "deal"), ["total", "node", "cell"])


class _Pair:
    """A block of queries and one of candidates at one node."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
        self.total, self.node = row["total"], row["node"]
        self.queries, self.ids, self.rows, self.lowest, self.cutoff = (
            np.frombuffer(row[c], dtype=np.int64)
            for c in ("q_vec_id", "vec_id", "row", "q_lowest", "q_cutoff")
        )
        asked = np.frombuffer(row["q_numbers"]).reshape(len(self.queries), -1)
        held = np.frombuffer(row["numbers"]).reshape(len(self.ids), -1)
        most = np.abs(asked).max(initial=0) * np.abs(held).max(initial=0) * asked.shape[1]
        self.exact = bool(most < EXACT)
        self.parts = (asked @ held.T).astype(np.int64) if self.exact else None
        self.own = self.queries[:, None] == self.ids


def _rows(columns: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    names = ["query_id", "node", "row", "vec_id", "part"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _gathered(pairs: DataFrame, count: int) -> DataFrame:
    """PARTS: each task's highest parts of each query and node, and the lowest (without a row;
    UNKNOWN where parts aren't exact)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        lowest: dict[tuple[int, int], int] = {}

        def handed_on() -> pa.RecordBatch:
            out = [(q, n, row, -minus, part) for (q, n), own in lists.items() for part, minus, row in own]
            out += [(q, n, None, None, part) for (q, n), part in lowest.items()]
            lists.clear()
            lowest.clear()
            return _rows(list(zip(*out)) or [[]] * 5)

        for batch in batches:
            for at in range(batch.num_rows):
                pair = _Pair(batch, at)
                keys = [(q, pair.node) for q in pair.queries.tolist()]
                if not pair.exact:
                    lowest.update(dict.fromkeys(keys, UNKNOWN))
                    continue
                least = pair.parts.min(axis=1)
                free = np.where(pair.own, UNKNOWN, pair.parts)
                width = min(count, free.shape[1])
                top = np.argpartition(-free.astype(np.float64), width - 1, axis=1)[:, :width]
                for k, key in enumerate(keys):
                    lowest[key] = min(int(least[k]), lowest.get(key, int(least[k])))
                    found = [
                        (int(free[k, c]), -int(pair.ids[c]), int(pair.rows[c]))
                        for c in top[k]
                        if not pair.own[k, c]
                    ]
                    lists[key] = sorted(lists.get(key, []) + found, reverse=True)[:count]
                if len(lowest) >= HELD_QUERIES * NODES:
                    yield handed_on()
        yield handed_on()

    return map_batches(pairs, gather, PARTS)


def _lists(gathered: DataFrame, count: int) -> DataFrame:
    """query_id, row, vec_id, known, told: the entries that are among the `count` highest of some
    node, with the sum of the parts that are known."""
    best = Window.partitionBy("query_id", "node").orderBy(F.desc("part"), "vec_id", "row")
    return (
        gathered.where("row is not null")
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= count)
        .groupBy("query_id", "row", "vec_id")
        .agg(F.sum("part").alias("known"), F.collect_set("node").alias("told"))
    )


def _cutoffs(scores: DataFrame, lowest: DataFrame, count: int) -> DataFrame:
    """query_id, cutoff: what the count-th highest of some whole scores exceeds the sum of the
    nodes' lowest by; none for queries with fewer scores or an unknown lowest."""
    floors = (
        lowest.groupBy("query_id")
        .agg(F.min("lowest").alias("least"), F.sum(F.nullif("lowest", F.lit(UNKNOWN))).alias("floor"))
        .where(F.col("least") != UNKNOWN)
    )
    return (
        ranked(scores, count)
        .where(F.col("rank") == count)
        .join(floors, "query_id")
        .select("query_id", (F.col("score") - F.col("floor")).alias("cutoff"))
    )


def _named(pairs: DataFrame) -> DataFrame:
    """PARTS: the entries that each node names. `part` is the excess, null where the node doesn't
    know it."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                pair = _Pair(batch, at)
                free = ~pair.own
                excess = None
                if pair.exact:
                    excess = pair.parts - np.where(pair.lowest == UNKNOWN, 0, pair.lowest)[:, None]
                    share = _share(pair.cutoff, min(NODES, pair.total))
                    free &= (pair.cutoff == UNKNOWN)[:, None] | (excess >= share[:, None])
                asked, found = np.nonzero(free)
                if excess is None:
                    parts = pa.nulls(len(asked), pa.int64())
                else:
                    known = pair.lowest[asked] != UNKNOWN
                    parts = pa.array(excess[asked, found], pa.int64(), mask=~known)
                yield _rows([
                    pair.queries[asked], np.full(len(asked), pair.node), pair.rows[found],
                    pair.ids[found], parts,
                ])

    return map_batches(pairs, name, PARTS)


def _share(cutoff, nodes: int):
    """The cutoff divided by the nodes, rounded up: excesses are whole."""
    return -(-cutoff // nodes)


def _resolved(rows: DataFrame) -> DataFrame:
    """query_id, vec_id, score: `known` and the product of `asked` and `held`, the components of
    the missing nodes."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = LONG_LIMITS
        for batch in batches:
            lengths = batch.column("held").value_lengths().to_numpy(zero_copy_only=False)
            asked, held = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("asked", "held"))
            starts = np.cumsum(lengths) - lengths
            with np.errstate(over="ignore", invalid="ignore"):
                products = asked * held
                sums = np.add.reduceat(products, starts)
                exact = np.add.reduceat(np.abs(products), starts) < EXACT
            known = batch.column("known").to_pylist()
            scores = [k + int(x) if sure else None for k, x, sure in zip(known, sums, exact)]
            for row in np.flatnonzero(~exact):
                part = slice(starts[row], starts[row] + lengths[row])
                scores[row] = known[row] + sum(int(x) * int(y) for x, y in zip(asked[part], held[part]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("query_id"),
                    batch.column("vec_id"),
                    pa.array([min(max(score, low), high) for score in scores], pa.int64()),
                ],
                names=["query_id", "vec_id", "score"],
            )

    return map_batches(rows, resolve, "query_id long, vec_id long, score long")


def _missing_part(vector: Column) -> Column:
    """The components of the nodes in `missing`."""
    total = F.size(vector)

    def part(node: Column) -> Column:
        first, last = _bounds(total, node)
        return F.slice(vector, first + 1, last - first)

    return F.flatten(F.transform("missing", part))


def top_products(vectors: DataFrame, is_query: Column, count: int = 5, vector: str = "embedding"):
    """query_id, rank (from 1), vec_id, score long: the `count` highest inner products of every
    row that meets is_query (a condition on vec_id), among all rows of vectors."""
    column = F.col(vector)
    whole = F.transform(column.cast("array<double>"), lambda x: _floor(x * FACTOR))
    rows = stored(
        vectors.where(F.col("vec_id").isNotNull() & usable(column))
        .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("vector"))
        # Tells repeated rows apart; stored, so that it stays what it is.
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    asking = stored(
        rows.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")), "asking"
    )
    candidates = stored(_pack(_nodes(rows), ["row", "vec_id"], CANDIDATE_ROWS), "nodes")
    asked = _nodes(asking).withColumnRenamed("vec_id", "query_id")

    def sent(lowest: DataFrame | None, cutoff: DataFrame | None) -> DataFrame:
        """The queries' blocks, with what is known for them."""
        out = asked
        if lowest is None:
            out = out.withColumns({"lowest": F.lit(UNKNOWN), "cutoff": F.lit(UNKNOWN)})
        else:
            out = out.join(lowest, ["query_id", "node"], "left").join(cutoff, "query_id", "left")
        unknown = {c: F.coalesce(F.col(c), F.lit(UNKNOWN)) for c in ("lowest", "cutoff")}
        out = out.withColumns(unknown).withColumnRenamed("query_id", "vec_id")
        return stored(_pack(out, ["vec_id", "lowest", "cutoff"], QUERY_ROWS), "queries")

    nodes = asking.select(
        F.col("vec_id").alias("query_id"), F.least(F.lit(NODES), F.size("vector")).alias("nodes")
    )
    missing = F.array_except(F.sequence(F.lit(0), F.col("nodes") - 1), "told")

    gathered = _gathered(_beside(candidates, sent(None, None)), LISTED * count)
    gathered = stored(gathered, "gathered")
    lowest = gathered.where("row is null").groupBy("query_id", "node").agg(F.min("part").alias("lowest"))
    lowest = stored(lowest, "lowest")
    listed = _lists(gathered, LISTED * count).join(nodes, "query_id").withColumn("missing", missing)
    listed = _completed(stored(listed, "lists"), rows, asking)
    cutoff = stored(_cutoffs(listed, lowest, count), "cutoffs")
    named = _named(_beside(candidates, sent(lowest, cutoff)))

    # Bounds from above, from what was named. A null part is one its node doesn't know.
    facts = nodes.join(cutoff, "query_id", "left").join(
        lowest.groupBy("query_id").agg(
            F.map_from_entries(F.collect_list(F.struct("node", "lowest"))).alias("lowest")
        ),
        "query_id",
        "left",
    )
    sums = (
        named.groupBy("query_id", "row", "vec_id")
        .agg(
            F.coalesce(F.sum("part"), F.lit(0)).alias("sum"),
            F.collect_set(F.when(F.col("part").isNotNull(), F.col("node"))).alias("told"),
        )
        .join(facts, "query_id")
        .withColumn("missing", missing)
    )
    share = F.ceil(F.col("cutoff") / F.col("nodes")) - 1
    highest = F.col("sum") + F.size("missing") * share
    # Divisions round by far less than one below 2**53, and excesses beyond that are not told.
    reach = F.coalesce(highest >= F.col("cutoff"), F.lit(True))
    of_told = F.aggregate(
        "told", F.lit(0).cast("long"), lambda total, node: total + F.element_at("lowest", node)
    )
    left = stored(
        sums.where(reach).select(
            "query_id", "row", "vec_id", (F.col("sum") + of_told).alias("known"), "missing"
        ),
        "entries",
    )
    return ranked(_completed(left, rows, asking), count).select(
        "query_id", "rank", "vec_id", "score"
    )


def _completed(entries: DataFrame, rows: DataFrame, asking: DataFrame) -> DataFrame:
    """query_id, vec_id, score of entries (query_id, row, vec_id, known, missing): only those with
    a node missing meet their vectors again."""
    complete = entries.where(F.size("missing") == 0).select(
        "query_id", "vec_id", F.col("known").alias("score")
    )
    asked_for = asking.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"))
    to_resolve = (
        entries.where(F.size("missing") > 0)
        .join(rows.select("row", "vector"), "row")
        .select("query_id", "vec_id", "known", "missing", _missing_part(F.col("vector")).alias("held"))
        .join(asked_for, "query_id")
        .select("query_id", "vec_id", "known", "held", _missing_part(F.col("asked")).alias("asked"))
    )
    return complete.unionByName(_resolved(to_resolve))


def _floor(number: Column) -> Column:
    """Largest whole number that is not greater, as double: floor() itself gives a long, which
    the greatest doubles don't fit. From 2**52 on every double is whole."""
    return F.when(F.abs(number) < 2.0**52, F.floor(number).cast("double")).otherwise(number)
