"""Toxicity of texts: a linear classifier of character n-grams scaled by log-count ratios.

Features are the n-grams of a text, lower-cased and padded with a space on both sides: each
counts once, however often it occurs, and stands in one of BUCKETS buckets by its hash. A
bucket's value is its naive Bayes log-count ratio between toxic and other texts; logistic
regression is learned on these values. A text's length is no feature: one strong n-gram in a
long text counts as much as in a short one.

Labels come from a bounded sample of the labelled documents (SAMPLE_ROWS, the smallest hashes
of doc_id), so training doesn't grow with the corpus. The ratios are counted by Spark tasks;
the buckets that tell the classes apart best are kept. A document counts once, with the text of
the smallest hash if rows of its doc_id differ. Scoring reads every text whole, in one
pass without a shuffle.

A null text is empty; empty texts get the score of a text without features. Labels that are
null or whose document is missing are not used; of several labels of a document the greatest
counts. With labels of one kind only or none, every text gets the share of toxic ones, 0 if
there is no label. Repeated rows are scored each; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.llm.stored import drop, stored
from wattledger.llm.workers import map_batches

GRAMS = (4, 5, 6)
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS

#: Labelled documents to learn from at most, and buckets kept for the classifier.
SAMPLE_ROWS = 20_000
KEPT_BUCKETS = 1 << 12
SMOOTHING = 1.0
PENALTY = 1e-3
STEPS = 300

#: Characters hashed together; a longer text is taken alone.
CHUNK_CHARS = 1 << 18


def held_out(doc_id: str = "doc_id") -> Column:
    """One fifth of the documents, by the checksum of the id as text; never learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def text_buckets(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, text after the last, text numbers, buckets) for runs of texts: every n-gram
    of each, as often as it occurs."""
    row = 0
    while row < len(texts):
        stop, size = row, 0
        while stop < len(texts) and (stop == row or size + len(texts[stop] or "") <= CHUNK_CHARS):
            size += len(texts[stop] or "")
            stop += 1
        # A zero stands between texts, and n-grams that hold it belong to none.
        padded = [f" {(text or '').lower()} ".replace("\0", " ") for text in texts[row:stop]]
        joined = "\0".join(padded).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(joined, dtype=np.uint32).copy()
        codes[(codes >= 9) & (codes <= 13)] = 32
        ends = np.cumsum([len(text) + 1 for text in padded]) - 1
        hashes = np.zeros(len(codes), dtype=np.uint32)
        owner = np.searchsorted(ends, np.arange(len(codes)), side="right").astype(np.int32)
        owners, buckets = [], []
        for place in range(max(GRAMS)):
            if len(codes) <= place:
                break
            hashes = hashes[: len(codes) - place] * np.uint32(0x9E3779B1) + codes[place:]
            if place + 1 in GRAMS:
                mixed = hashes + np.uint32(place)
                mixed ^= mixed >> np.uint32(15)
                mixed *= np.uint32(0x85EBCA6B)
                mixed ^= mixed >> np.uint32(13)
                mixed *= np.uint32(0xC2B2AE35)
                # Within one text: no separator from the first to the last character.
                inside = owner[: len(hashes)] == owner[place:]
                inside &= codes[place:] != 0
                owners.append(owner[: len(hashes)][inside])
                buckets.append((mixed >> np.uint32(32 - BUCKET_BITS))[inside])
        if owners:
            yield row, stop, np.concatenate(owners), np.concatenate(buckets)
        else:
            yield row, stop, np.zeros(0, np.int32), np.zeros(0, np.uint32)
        row = stop


def once(owners: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket once per text, by text."""
    pairs = np.unique(owners.astype(np.int64) << BUCKET_BITS | buckets)
    return (pairs >> BUCKET_BITS).astype(np.int32), pairs & (BUCKETS - 1)


@dataclass
class Model:
    """weights: per bucket, its ratio times what was learned; zero for buckets not kept."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        used = self.weights != 0
        total = np.full(len(texts), self.bias)
        for first, stop, owners, buckets in text_buckets(texts):
            chosen = used[buckets]
            owners, buckets = once(owners[chosen], buckets[chosen])
            total[first:stop] += np.bincount(
                owners, weights=self.weights[buckets], minlength=stop - first
            )
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def labelled_texts(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """text and toxic (0 or 1) of at most `rows` labelled documents that aren't held out: those
    with the smallest hash of doc_id. Of several rows of a doc_id the text with the smallest
    hash is taken."""
    learned = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # Bounded by `rows`: two numbers each.
    found = docs.select("doc_id", "text").join(F.broadcast(learned), "doc_id")
    # Reduced in each task before the shuffle, however often a doc_id repeats.
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    return found.groupBy("doc_id", "toxic").agg(first).select("first.text", "toxic")


def _bucket_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Texts per bucket, toxic and other, and how many texts of each kind there are."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS + 1), dtype=np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False) > 0
            for first, stop, owners, buckets in text_buckets(batch.column("text").to_pylist()):
                owners, buckets = once(owners, buckets)
                kinds = toxic[first:stop]
                for kind in (0, 1):
                    counts[kind, :-1] += np.bincount(
                        buckets[kinds[owners] == kind], minlength=BUCKETS
                    )
                    counts[kind, -1] += int((kinds == kind).sum())
        there = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_pydict(
            {"bucket": there, "other": counts[0, there], "toxic": counts[1, there]}
        )

    parts = map_batches(sample, counted, "bucket long, other long, toxic long")
    # At most one row per bucket.
    rows = parts.groupBy("bucket").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    counts = np.zeros((2, BUCKETS + 1), dtype=np.int64)
    for row in rows.toLocalIterator():
        counts[:, row["bucket"]] = row["other"], row["toxic"]
    return counts[0, :-1], counts[1, :-1], int(counts[0, -1]), int(counts[1, -1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """labels: doc_id and toxic."""
    sample = stored(labelled_texts(docs, labels, sample_rows), "sample")
    other, toxic, n_other, n_toxic = _bucket_counts(sample)
    if not n_other or not n_toxic:
        share = n_toxic / max(1, n_other + n_toxic)
        drop(sample)
        return Model(np.zeros(BUCKETS), 500.0 if share else -500.0)
    ratio = np.log((toxic + SMOOTHING) / (toxic + SMOOTHING).sum()) - np.log(
        (other + SMOOTHING) / (other + SMOOTHING).sum()
    )
    # Buckets whose share of toxic texts differs most from that of others, by its error.
    share = (toxic + other + SMOOTHING) / (n_toxic + n_other + 2 * SMOOTHING)
    error = np.sqrt(share * (1 - share) * (1 / n_toxic + 1 / n_other))
    apart = np.abs(toxic / n_toxic - other / n_other) / error
    apart[toxic + other < 2] = 0
    kept = np.sort(np.argsort(-apart, kind="stable")[:KEPT_BUCKETS])
    kept = kept[apart[kept] > 0]
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[kept] = np.arange(len(kept))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = []
            for first, stop, owners, buckets in text_buckets(texts):
                chosen = place[buckets] >= 0
                owners, buckets = once(owners[chosen], buckets[chosen])
                bounds = np.searchsorted(owners, np.arange(stop - first + 1))
                places = place[buckets]
                found += [places[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch.column("toxic")], names=["places", "toxic"]
            )

    # Bounded by sample_rows and KEPT_BUCKETS.
    rows = map_batches(sample, features, "places binary, toxic int").toArrow()
    drop(sample)
    target = rows.column("toxic").to_numpy().astype(np.float64)
    places = [np.frombuffer(p, dtype=np.int32) for p in rows.column("places").to_pylist()]
    columns = np.concatenate(places)
    owners = np.repeat(np.arange(len(places)), [len(p) for p in places])
    learned, bias = _logistic(owners, columns, target, ratio[kept])
    weights = np.zeros(BUCKETS)
    weights[kept] = learned * ratio[kept]
    return Model(weights, bias)


def _logistic(
    owners: np.ndarray, columns: np.ndarray, target: np.ndarray, ratio: np.ndarray
) -> tuple[np.ndarray, float]:
    """Logistic regression on features worth their ratio, with a quadratic penalty, by
    accelerated gradient steps (Nesterov's) of the length that the features' spread allows. Toxic
    texts, of which there are few, weigh as much together as the others."""
    rows, count = len(target), len(ratio)
    weight = np.where(target > 0, 0.5 / target.sum(), 0.5 / (rows - target.sum()))

    def totals(weights: np.ndarray) -> np.ndarray:
        return np.bincount(owners, weights=(weights * ratio)[columns], minlength=rows)

    def back(errors: np.ndarray) -> np.ndarray:
        return ratio * np.bincount(columns, weights=errors[owners], minlength=count)

    # The greatest curvature, by power iteration.
    direction, spread = np.ones(count), 0.0
    for _ in range(12):
        direction = back(weight * totals(direction))
        spread = float(np.linalg.norm(direction)) or 1.0
        direction /= spread
    step = 1 / (0.25 * (spread + 1) + PENALTY)
    learned = ahead = np.zeros(count)
    bias = bias_ahead = -1.0
    for k in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(totals(ahead) + bias_ahead, -500, 500)))
        wrong = weight * (chance - target)
        moved = ahead - step * (back(wrong) + PENALTY * ahead)
        bias_moved = bias_ahead - step * wrong.sum()
        ahead = moved + k / (k + 3) * (moved - learned)
        bias_ahead = bias_moved + k / (k + 3) * (bias_moved - bias)
        learned, bias = moved, bias_moved
    return learned, float(bias)


def score_texts(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and score for every row of docs."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*keep, "score"]
            )

    read = docs.select(*keep, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return map_batches(read, scored, f"{kept}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below the threshold, as they are."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("text").to_pylist())
            yield batch.filter(pa.array(scores < threshold))

    return map_batches(docs, clean, docs.schema)
