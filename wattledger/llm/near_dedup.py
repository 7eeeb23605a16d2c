"""Near-duplicate documents: MinHash with tensored banding, verified on full shingle sets.

Two collections of BANDS bands each are made from 2 * BANDS * ROWS minhashes. A hash table is
keyed by a band of the first together with a band of the second, so there are BANDS squared
tables from about the square root of the minhashes that as many independent ones would take. A
pair with similarity s meets in some table with probability (1 - (1 - s**ROWS) ** BANDS) ** 2:
0.9995 at 0.75, 0.99998 at 0.82.

A table key that two documents share has both its bands shared, so only bands that occur in two
documents at least are combined; most documents have none and make no table row.

Documents with the same shingle set are one class, which its smallest document stands for.
Links are found in two steps, so that the pairs handed on grow with the documents, not with the
square of a group:

1. In each of ROUNDS rounds every bucket has a centre, in the first its smallest member, then
   one drawn by a hash, and every member is compared with one centre of another component than
   its own. That joins most of a large group of copies by a pair a document and round.
2. What is still apart is compared in full, across components: documents that share a band
   of the first collection stand in blocks with their whole sets, every block beside every
   other one that holds more than the same single component. A tile of two blocks counts the
   shingles that each of its pairs has in common as a product of matrices, and hands on such
   links only that join components which its task hasn't seen joined before.

No sketch decides about a link: what step 1 passes over (pairs with sizes too different or
fewer than LEAST_EQUAL of 40 minhashes equal) step 2 compares whole, if it is still apart. So
the only links missed are those of pairs that share no table key.

A null text or one without words has no shingles and is linked with nothing. Rows without a
doc_id are linked with nothing, their component is null, and they are kept. Repeated rows give
a row each; a doc_id with several texts is linked where any of them is. Empty tables give no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.bloom import filter_bits, filter_block
from wattledger.llm.components import connected
from wattledger.llm.stored import stored
from wattledger.llm.words import Words, chunks, mix, windows
from wattledger.llm.workers import map_batches
from wattledger.operators.joins import join_groups

SHINGLE_WORDS = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS = 10, 2
HASHES = 2 * BANDS * ROWS
LEAST_EQUAL = 18
#: Rounds in which documents are compared with centres of their buckets.
ROUNDS = 2
#: Documents and shingles in a block of the last step, about.
BLOCK_ROWS, BLOCK_SHINGLES = 128, 1 << 17
#: Shingles that a tile counts at a time.
TILE_COLUMNS = 8192
#: Pairs whose sets are made together.
COMPARED_ROWS = 256
#: Blocks of the filter that keeps texts out of a join that no pair asks for (2 MiB).
FILTER_BLOCKS = 1 << 17

_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, bounds): document k has the distinct, sorted shingles[bounds[k]:bounds[k+1]].
    With fewer than SHINGLE_WORDS words the whole sequence is one shingle."""
    words = words.lower()
    hashes = words.hashes()
    counts = words.counts()
    owner = words.document_of_word()
    shingles = windows(hashes, SHINGLE_WORDS)
    last = owner[SHINGLE_WORDS - 1 :]
    whole = owner[: len(shingles)] == last if len(shingles) else np.zeros(0, bool)
    owners, values = owner[: len(shingles)][whole], shingles[whole]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    few = [
        mix(windows(hashes[words.first[k] : words.first[k + 1]], counts[k]) + np.uint64(counts[k]))
        for k in short
    ]
    if few:
        owners = np.concatenate([owners, short])
        values = np.concatenate([values, *few])
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    owners, values = owners[new], values[new]
    return values, np.searchsorted(owners, np.arange(len(counts) + 1))


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (a 128-bit sum over the set), minhashes (array of
    HASHES ints, null without shingles)."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, stop, words in chunks(batch.column("text")):
                values, bounds = shingle_sets(words)
                sizes = np.diff(bounds)
                some = np.flatnonzero(sizes)
                starts = bounds[some]
                sums = np.zeros((2, stop - first), dtype=np.uint64)
                minhashes = np.zeros((HASHES, len(some)), dtype=np.int32)
                if len(some):
                    for k in (0, 1):
                        salted = mix(values + np.uint64(k + 1))
                        sums[k, some] = np.add.reduceat(salted, starts)
                    for k, seed in enumerate(_SEEDS):
                        hashed = (values * seed) >> np.uint64(32)
                        least = np.minimum.reduceat(hashed, starts)
                        minhashes[k] = least.astype(np.uint32).view(np.int32)
                lists = iter(minhashes.T.tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, stop - first),
                        pa.array(sizes, pa.int64()),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.array(
                            [next(lists) if size else None for size in sizes],
                            pa.list_(pa.int32()),
                        ),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "minhashes"],
                )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_shingles long, set_a long, set_b long, minhashes array<int>"
    return map_batches(read, sketched, schema)


def _bands(collection: int) -> Column:
    """The bands of a collection as one hash each, the band's number included."""
    first = collection * BANDS * ROWS
    return F.array(
        *[
            F.xxhash64(
                F.lit(collection * BANDS + band),
                *[F.col("minhashes")[first + band * ROWS + row] for row in range(ROWS)],
            )
            for band in range(BANDS)
        ]
    )


def table_rows(classes: DataFrame) -> DataFrame:
    """key, doc: the table rows of every class that can meet another one. classes: doc and
    minhashes."""
    bands = classes.select("doc", _bands(0).alias("a"), _bands(1).alias("b")).select(
        "doc", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("keys")),
                                 F.struct(F.lit(1).alias("side"), F.col("b").alias("keys"))))
        .alias("c")
    ).select("doc", "c.side", F.explode("c.keys").alias("band"))
    shared = stored(
        bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band"), "bands"
    )
    met = (
        bands.join(shared, "band", "left_semi")
        .groupBy("doc")
        .agg(
            F.collect_list(F.when(F.col("side") == 0, F.col("band"))).alias("a"),
            F.collect_list(F.when(F.col("side") == 1, F.col("band"))).alias("b"),
        )
    )
    keys = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
    return met.select("doc", F.explode(keys).alias("key"))


def _promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (u, v and other columns) that neither sizes nor minhashes rule out."""
    facts = classes.select("doc", "n_shingles", "minhashes")
    left = facts.select(
        F.col("doc").alias("u"), F.col("n_shingles").alias("n_u"), F.col("minhashes").alias("h_u")
    )
    right = facts.select(
        F.col("doc").alias("v"), F.col("n_shingles").alias("n_v"), F.col("minhashes").alias("h_v")
    )
    return pairs.join(left, "u").join(right, "v").where(_similar()).select(*pairs.columns)


def _similar() -> Column:
    sizes = 100 * F.least("n_u", "n_v") >= PERCENT * F.greatest("n_u", "n_v")
    equal = F.size(F.filter(F.zip_with("h_u", "h_v", lambda x, y: x == y), lambda same: same))
    return sizes & (equal >= LEAST_EQUAL)


def _asked_for(docs: DataFrame, named: DataFrame) -> DataFrame:
    """docs without most of those that `named` (doc_id) doesn't name: a Bloom filter of fixed
    size, one row per block, so that whole texts of other documents aren't shuffled."""
    key = F.col("doc_id")
    blocks = named.groupBy(filter_block(key, FILTER_BLOCKS).alias("block")).agg(
        F.bit_or(filter_bits(key)).alias("bits")
    )
    held = filter_block(docs["doc_id"], FILTER_BLOCKS) == blocks["block"]
    bits = filter_bits(docs["doc_id"])
    return docs.join(
        F.broadcast(blocks), held & (blocks["bits"].bitwiseAND(bits) == bits), "left_semi"
    )


def _sets(batch: pa.RecordBatch, name: str) -> Iterator[np.ndarray]:
    """The shingle set of each text of a column."""
    for _, _, words in chunks(batch.column(name)):
        values, bounds = shingle_sets(words)
        for a, b in zip(bounds, bounds[1:]):
            yield values[a:b]


def _linked(left: np.ndarray, right: np.ndarray) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    return common > 0 and 100 * common >= PERCENT * (len(left) + len(right) - common)


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) whose full sets are similar enough. docs: doc_id, text; rows of
    one doc_id that differ are all compared."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, COMPARED_ROWS):
                part = batch.slice(start, COMPARED_ROWS)
                linked = [
                    _linked(left, right)
                    for left, right in zip(_sets(part, "text_u"), _sets(part, "text_v"))
                ]
                yield part.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    ends = [pairs.select(F.col(end).alias("doc_id")) for end in ("u", "v")]
    texts = _asked_for(docs, ends[0].unionAll(ends[1]))
    rows = (
        pairs.join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v")), "v")
        .join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u")), "u")
        .select("u", "v", "text_u", "text_v")
    )
    return map_batches(rows, confirm, "u long, v long").distinct()


def _stars(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (u, v, and their labels): each member with one of its buckets' centres of other
    components."""

    def drawn(doc: str) -> Column:
        return F.col(doc) if turn == 0 else F.xxhash64(doc, F.lit(turn))

    centres = members.groupBy("key").agg(
        F.min_by("doc", drawn("doc")).alias("centre"),
        F.min_by("label", drawn("doc")).alias("its_label"),
    )
    chosen = (
        join_groups(members, centres, ["key"], ["doc"])
        .where(F.col("label") != F.col("its_label"))
        .groupBy("doc", "label")
        .agg(F.min_by(F.struct("centre", "its_label"), drawn("centre")).alias("other"))
    )
    return chosen.select(
        F.least("doc", "other.centre").alias("u"),
        F.greatest("doc", "other.centre").alias("v"),
        F.least("label", "other.its_label").alias("low"),
        F.greatest("label", "other.its_label").alias("high"),
    ).distinct()


def _hooks(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """label, new: labels that links join to a smaller one, followed twice."""
    once = (
        pairs.join(found, ["u", "v"], "left_semi")
        .groupBy(F.col("high").alias("label"))
        .agg(F.min("low").alias("new"))
    )
    once = stored(once, "hooks")
    further = once.select(F.col("label").alias("new"), F.col("new").alias("newer"))
    return once.join(further, "new", "left").select("label", F.coalesce("newer", "new").alias("new"))


def _still_apart(members: DataFrame, hooks: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with their components."""
    labelled = stored(
        members.join(hooks, "label", "left").select(
            "key", "doc", F.coalesce("new", "label").alias("label")
        ),
        "labelled",
    )
    mixed = (
        labelled.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low < high")
        .select("key")
    )
    return stored(join_groups(labelled, mixed, ["key"], ["doc"]).select("key", "doc", "label"), "members")


def _whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, shingles (sorted 64-bit hashes): the whole sets of the documents in wanted (doc)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, words in chunks(batch.column("text")):
                values, bounds = shingle_sets(words)
                sets = [values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(first, stop - first), pa.array(sets, pa.binary())],
                    names=["doc", "shingles"],
                )

    texts = _asked_for(docs, wanted.withColumnRenamed("doc", "doc_id"))
    read = texts.withColumnRenamed("doc_id", "doc").join(wanted, "doc", "left_semi")
    return map_batches(read.select("doc", "text"), cut, "doc long, shingles binary").distinct()


def _blocks(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """band, home, block, held (array of doc, label, shingles): the members of the bands of the
    first collection that hold more than one component. Members of a component that fills blocks
    of its own have it as their home, others 0 and no `single`."""
    apart = stored(members.select("doc", "label").distinct(), "apart")
    rows = apart.join(classes, "doc").select(
        "doc", "label", "n_shingles", F.explode(_bands(0)).alias("band")
    )
    rows = stored(rows, "banded")
    labels = rows.groupBy("band", "label").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")
    )
    single = F.col("n") >= BLOCK_ROWS
    homes = labels.withColumn("single", single).withColumn(
        "home", F.when(single, F.col("label")).otherwise(0)
    )
    homes = stored(homes, "homes")
    mixed = homes.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    sizes = (
        homes.join(mixed.where("low < high").select("band"), "band", "left_semi")
        .groupBy("band", "single", "home")
        .agg(
            F.greatest(
                F.ceil(F.sum("n") / BLOCK_ROWS), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)
            ).alias("blocks")
        )
    )
    placed = (
        rows.join(homes.select("band", "label", "single", "home"), ["band", "label"])
        .join(sizes, ["band", "single", "home"])
        .withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
        .select("band", "single", "home", "block", "doc", "label")
    )
    sets = stored(_whole_sets(docs, apart.select("doc")), "sets")
    return (
        placed.join(sets, "doc")
        .groupBy("band", "single", "home", "block")
        .agg(F.collect_list(F.struct("doc", "label", "shingles")).alias("held"))
    )


def _across(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (u, v) that join different components, among members that share a band of the first
    collection."""
    blocks = stored(_blocks(members, classes, docs), "blocks")
    place = F.struct("single", "home", "block").alias("place")
    one = blocks.select("band", place, F.col("held").alias("u"))
    other = blocks.select("band", place.alias("place_v"), F.col("held").alias("v"))
    same_component = (
        F.col("place.single") & F.col("place_v.single")
        & (F.col("place.home") == F.col("place_v.home"))
    )
    tiles = one.join(other, "band").where((F.col("place") <= F.col("place_v")) & ~same_component)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = Joined()
        for batch in batches:
            for k in range(batch.num_rows):
                one, other = (Block(batch.column(side)[k].values) for side in ("u", "v"))
                pairs = joining_links(one, other, joined)
                u, v = zip(*pairs) if pairs else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
                )

    return map_batches(tiles.select("u", "v"), compare, "u long, v long").distinct()


class Joined:
    """Components that a task has seen joined."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, label: int) -> int:
        while (up := self.above.get(label, label)) != label:
            self.above[label] = self.above.get(up, up)
            label = up
        return label

    def join(self, a: int, b: int) -> bool:
        """Whether they were apart."""
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


class Block:
    """A block's documents: ids, labels, and their sets one after the other."""

    def __init__(self, held: pa.StructArray):
        self.doc, self.label = (held.field(c).to_numpy(zero_copy_only=False) for c in ("doc", "label"))
        sets = [np.frombuffer(own, dtype=np.uint64) for own in held.field("shingles").to_pylist()]
        self.size = np.array([len(own) for own in sets], dtype=np.int64)
        self.owner = np.repeat(np.arange(len(sets)), self.size)
        self.shingles = np.concatenate(sets)

    def incidence(self, shingles: np.ndarray) -> np.ndarray:
        """Which documents hold which of these sorted shingles, as 0 and 1."""
        at = np.minimum(np.searchsorted(shingles, self.shingles), len(shingles) - 1)
        there = shingles[at] == self.shingles
        out = np.zeros((len(self.doc), len(shingles)), dtype=np.float32)
        out[self.owner[there], at[there]] = 1
        return out


def shared_shingles(one: Block, other: Block) -> np.ndarray:
    """The size of the intersection of each document's set with each of the other block's."""
    shared = np.zeros((len(one.doc), len(other.doc)), dtype=np.int64)
    both = np.intersect1d(one.shingles, other.shingles)
    for start in range(0, len(both), TILE_COLUMNS):
        part = both[start : start + TILE_COLUMNS]
        shared += (one.incidence(part) @ other.incidence(part).T).astype(np.int64)
    return shared


def joining_links(one: Block, other: Block, joined: Joined) -> list[tuple[int, int]]:
    """Links (smaller, greater) of the tile that join components not yet joined."""
    left, right = (
        np.array([joined.root(label) for label in block.label.tolist()]) for block in (one, other)
    )
    wanted = left[:, None] != right
    if not wanted.any():
        return []
    shared = shared_shingles(one, other)
    union = one.size[:, None] + other.size - shared
    wanted &= (shared > 0) & (100 * shared >= PERCENT * union)
    return [
        (int(min(one.doc[a], other.doc[b])), int(max(one.doc[a], other.doc[b])))
        for a, b in zip(*np.nonzero(wanted))
        if joined.join(int(one.label[a]), int(other.label[b]))
    ]


def group_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links lead to), kept, for
    every row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stored(sketch(docs), "sketches")
    worded = sketches.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    same_set = ["n_shingles", "set_a", "set_b"]
    smallest = stored(worded.groupBy(*same_set).agg(F.min("doc_id").alias("doc")), "classes")
    classes = stored(
        worded.withColumnRenamed("doc_id", "doc")
        .join(smallest, ["doc", *same_set], "left_semi")
        .select("doc", *same_set, "minhashes")
        .distinct(),
        "minhashes",
    )

    rows = stored(table_rows(classes).distinct(), "tables")
    buckets = stored(
        rows.groupBy("key")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        .where("low < high")
        .select("key"),
        "buckets",
    )
    # Members with the component that each is known to be in: so far its own.
    members = stored(
        rows.join(buckets, "key", "left_semi").withColumn("label", F.col("doc")), "members"
    )
    links = None
    for turn in range(ROUNDS):
        pairs = stored(_promising(_stars(members, turn), classes), "pairs")
        found = stored(_verified(pairs, docs), "links")
        links = found if links is None else links.unionAll(found)
        # Labels that fall short of whole components only mean some comparisons more.
        members = _still_apart(members, _hooks(pairs, found))
        if members.isEmpty():
            break
    else:
        links = links.unionAll(stored(_across(members, classes, docs), "links"))

    component = stored(connected(links), "components")
    membership = sketches.select("doc_id", *same_set).join(smallest, same_set, "left")
    return (
        membership.join(component.withColumnRenamed("node", "doc"), "doc", "left")
        .withColumn(
            "component_id",
            F.when(
                F.col("doc_id").isNotNull(), F.coalesce("component", "doc", "doc_id")
            ),
        )
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
