"""Repeated passages: a De Bruijn graph of word windows, compacted through joins.

An edge is a window of WINDOW words in a row. Edges that share their anchor (the smallest hash
among their runs of ANCHOR_WORDS words) and follow each other form a path; its edges belong
together, and equal edges have equal anchors wherever they stand. So the graph is built in
these steps, each a join or an aggregation on anchors:

1. Anchors that occur in one document only are dropped: no edge at them repeats.
2. Documents are cut into paths at the others. A path keeps its edges' hashes, a second hash of
   its words, made with other byte codes, and its coordinates (document, first word).
3. Equal paths are compacted into one, whose source is its smallest document. Where an anchor
   has a single such path the graph doesn't branch, and the path stands for all its edges.
4. Where it branches, the edges of the compacted paths are compared one by one.

A path repeats if its source is another document; an edge of a source path repeats if a path
of a smaller document holds it. Whole paths must agree in both hashes, 128 bits, with the path at
the source's coordinates; single edges in anchor and edge, 64 bits each. Words are not compared
beyond that.

Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Null texts have no words. A row without a doc_id is no source and loses nothing;
repeated rows lose the same words each; texts that share a doc_id are told apart by a hash, and
each loses its own words; a doc_id is no source for itself, so passages that only
repeat within one document stay. Empty tables give no rows. What only differs in extra columns
is the same; they are not read by keep_first, and left as they are by drop_repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.stored import drop, stored
from wattledger.llm.texts import with_texts
from wattledger.llm.words import Words, chunks, mix, sliding_minimum, windows
from wattledger.llm.workers import map_batches

WINDOW = 13
ANCHOR_WORDS = 5

#: The column that carries repeated spans to the texts; with more signs where a table has it.
SPANS = "_repeated_spans"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Paths:
    """The paths of a few documents: owner (which document), start (its first word there),
    first (index of its first edge among all words), edges (how many), anchor."""

    def __init__(self, words: Words):
        count = len(words) - WINDOW + 1
        if count <= 0:
            self.owner = self.start = self.first = self.edges = np.zeros(0, dtype=np.int64)
            self.anchor = np.zeros(0, dtype=np.uint64)
            return
        self.hashes = words.hashes(1)
        anchors = sliding_minimum(windows(self.hashes, ANCHOR_WORDS), WINDOW - ANCHOR_WORDS + 1)
        document = words.document_of_word()
        at = np.flatnonzero(document[:count] == document[WINDOW - 1 :])
        anchors, document = anchors[at], document[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (anchors[1:] != anchors[:-1]) | (document[1:] != document[:-1])
        begins = np.flatnonzero(new)
        self.first = at[begins]
        self.edges = np.diff(begins, append=len(at))
        self.owner = document[begins]
        self.start = self.first - words.first[self.owner]
        self.anchor = anchors[begins]

    def only(self, chosen: np.ndarray) -> None:
        for name in ("owner", "start", "first", "edges", "anchor"):
            setattr(self, name, getattr(self, name)[chosen])


def anchors(docs: DataFrame) -> DataFrame:
    """anchor, doc_id: the anchors of every document, each once."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, _, words in chunks(batch.column("text")):
                paths = Paths(words)
                order = np.lexsort((paths.anchor, paths.owner))
                anchor, owner = paths.anchor[order], paths.owner[order]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[new].view(np.int64)),
                        pa.array(ids[first + owner[new]], pa.int64()),
                    ],
                    names=["anchor", "doc_id"],
                )

    return map_batches(
        docs.where(F.col("doc_id").isNotNull()), found, "anchor long, doc_id long"
    )


def _text_hash() -> Column:
    """Tells texts that share a doc_id apart."""
    return F.xxhash64("text").alias("text_hash")


def paths_at(docs: DataFrame, met: DataFrame) -> DataFrame:
    """anchor, doc_id, text_hash, start, edges (array of hashes), check: the paths of documents
    at the anchors that `met` (doc_id, anchors) lists for them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            texts = batch.column("text_hash").to_numpy(zero_copy_only=False)
            lists = batch.column("anchors")
            for first, stop, words in chunks(batch.column("text")):
                paths = Paths(words)
                wanted = lists.slice(first, stop - first)
                owner = np.repeat(
                    np.arange(stop - first), wanted.value_lengths().to_numpy(zero_copy_only=False)
                )
                flat = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                paths.only(
                    np.isin(
                        paths.anchor * _FACTOR + paths.owner.astype(np.uint64),
                        flat * _FACTOR + owner.astype(np.uint64),
                    )
                )
                if not len(paths.first):
                    continue
                edges = windows(words.hashes(0), WINDOW)
                others = windows(paths.hashes, WINDOW)
                bounds = np.concatenate([[0], np.cumsum(paths.edges)])
                index = np.repeat(paths.first - bounds[:-1], paths.edges) + np.arange(bounds[-1])
                # The path's second hash: of its edges' second hashes, in order.
                weights = mix(np.arange(bounds[-1]).astype(np.uint64) - np.repeat(
                    bounds[:-1], paths.edges).astype(np.uint64) + np.uint64(1)) | np.uint64(1)
                check = mix(np.add.reduceat(others[index] * weights, bounds[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(paths.anchor.view(np.int64)),
                        pa.array(ids[first + paths.owner], pa.int64()),
                        pa.array(texts[first + paths.owner], pa.int64()),
                        pa.array(paths.start, pa.int32()),
                        pa.ListArray.from_arrays(
                            pa.array(bounds, pa.int32()), pa.array(edges[index].view(np.int64))
                        ),
                        pa.array(check.view(np.int64)),
                    ],
                    names=["anchor", "doc_id", "text_hash", "start", "edges", "check"],
                )

    schema = "anchor long, doc_id long, text_hash long, start int, edges array<long>, check long"
    read = docs.join(met, "doc_id").select("doc_id", _text_hash(), "text", "anchors")
    return map_batches(read, cut, schema)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, start, edges, source_id, source_start: runs of windows (`edges` many, the first
    at word `start`) that also stand in a document with a smaller doc_id, at its word
    source_start. docs: doc_id, text."""
    return _spans_and_tables(docs)[0]


def _spans_and_tables(docs: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The repeated spans, and the stored tables that they are made from."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = stored(
        anchors(docs).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"),
        "anchors",
    )
    met = stored(
        anchors(docs)
        .join(shared, "anchor", "left_semi")
        .groupBy("doc_id")
        .agg(F.collect_set("anchor").alias("anchors")),
        "met",
    )
    drop(shared)
    paths = stored(
        paths_at(docs, met).select(
            "anchor",
            F.xxhash64("edges").alias("path"),
            "check",
            "doc_id",
            "text_hash",
            "start",
            F.size("edges").alias("n"),
            "edges",
        ),
        "paths",
    )
    drop(met)
    same_path = ["anchor", "path", "check", "n"]
    compacted = stored(
        paths.groupBy(*same_path).agg(
            F.min("doc_id").alias("source_id"), F.min_by("start", "doc_id").alias("source_start")
        ),
        "compacted",
    )
    whole = (
        paths.select(*same_path, "doc_id", "text_hash", "start")
        .join(compacted, same_path)
        .where(F.col("doc_id") > F.col("source_id"))
        .select(
            "doc_id", "text_hash", "start", F.col("n").alias("edges"), "source_id", "source_start"
        )
    )

    branching = stored(
        compacted.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"),
        "branching",
    )
    branches = compacted.join(branching, "anchor", "left_semi").select(*same_path, "source_id")
    edges = stored(
        paths.join(branches, same_path)
        .where(F.col("doc_id") == F.col("source_id"))
        .select(
            "anchor", "doc_id", "text_hash", "start", F.posexplode("edges").alias("place", "edge")
        )
        .select(
            "anchor", "edge", "doc_id", "text_hash", (F.col("start") + F.col("place")).alias("start")
        ),
        "edges",
    )
    first = stored(
        edges.groupBy("anchor", "edge").agg(
            F.min("doc_id").alias("source_id"), F.min_by("start", "doc_id").alias("source_start")
        ),
        "first",
    )
    single = (
        edges.join(first, ["anchor", "edge"])
        .where(F.col("doc_id") > F.col("source_id"))
        .select(
            "doc_id", "text_hash", "start", F.lit(1).alias("edges"), "source_id", "source_start"
        )
    )
    return whole.unionAll(single), [paths, compacted, branching, edges, first]


def _free_name(docs: DataFrame) -> str:
    name = SPANS
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return name


def _with_spans(docs: DataFrame, name: str) -> DataFrame:
    """docs and a column of each text's repeated spans (null if there are none). A text's spans
    are a set: repeated rows find the same ones."""
    found, tables = _spans_and_tables(docs)
    spans = stored(
        found.groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("start", "edges")).alias(name)),
        "spans",
    )
    drop(*tables)
    same_text = (docs["doc_id"] == spans["doc_id"]) & (
        F.xxhash64(docs["text"]) == spans["text_hash"]
    )
    return docs.join(spans, same_text, "left").select(
        *[docs[column] for column in docs.columns], spans[name]
    )


def _removed(words: int, spans: list[dict] | None) -> np.ndarray:
    """Which of a document's words a repeated window covers."""
    change = np.zeros(words + 1, dtype=np.int64)
    for span in spans or ():
        change[span["start"]] += 1
        change[min(words, span["start"] + span["edges"] + WINDOW - 1)] -= 1
    return np.cumsum(change)[:words] > 0


def keep_first(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space), for every
    row of docs (doc_id, text)."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removals, texts = [], [], []
            for text, spans in zip(batch.column("text"), batch.column(SPANS)):
                words = (text.as_py() or "").encode().split()
                gone = _removed(len(words), spans.as_py())
                removals.append(int(gone.sum()))
                totals.append(len(words))
                if removals[-1]:
                    words = [words[k] for k in np.flatnonzero(~gone)]
                texts.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(totals, pa.int64()),
                    pa.array(removals, pa.int64()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(
        _with_spans(read, SPANS), kept, "doc_id long, n_words long, n_removed long, kept string"
    )


def drop_repeats(docs: DataFrame, length: str | None = None) -> DataFrame:
    """docs with repeated words cut out of `text`, white space before each included; texts
    without repeats stay as they are. length: a column that holds a text's code points, to be
    kept right."""
    carried = _free_name(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            changed = {}
            for row, spans in enumerate(batch.column(carried)):
                text = batch.column("text")[row].as_py() if spans.is_valid else None
                if text:
                    changed[row] = cut_words(text, spans.as_py())
            names = [name for name in batch.schema.names if name != carried]
            yield with_texts(batch.select(names), changed, length)

    return map_batches(_with_spans(docs, carried), cut, docs.schema)


def cut_words(text: str, spans: list[dict]) -> str:
    """The text without its repeated words and the white space before each."""
    data = text.encode()
    words = Words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    gone = _removed(len(words), spans)
    pieces, at = [], 0
    edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    for a, b in zip(edge[::2], edge[1::2]):
        begin = int(words.ends[a - 1]) if a else int(words.starts[0])
        pieces.append(data[at:begin])
        at = int(words.ends[b - 1])
    pieces.append(data[at:])
    return b"".join(pieces).decode()
