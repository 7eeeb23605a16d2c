"""Best-two-fit packing of tokenized documents into sequences of a fixed length.

Documents are encoded, closed by an end id and, if longer than a sequence, cut into pieces of
full length of which the first may be shorter. A sequence is filled greedily, the longest piece
that fits first; then its smallest piece is taken out again if two unpacked pieces fill the
widened gap more tightly.

Only lengths matter to a plan, and there are at most `capacity` of them. So the plan is made
over the histogram of lengths: what a sequence holds, and how many sequences are alike. Each
step uses up some length, so the plan has at most about capacity * ln(capacity) kinds however
many documents there are. Pieces then find their place by their number among those of their
length, which is counted within shares of each length, dealt by the place of a row in the input, so
that no length and no repeated row, however frequent, meets in one task.

A null text is empty (a sequence piece of its end id alone); a null doc_id is kept; repeated
rows are packed each; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattledger.llm.stored import stored
from wattledger.llm.workers import map_batches

#: Shares into which the pieces of one length are dealt: so many at least, and as many as it
#: takes for this number of pieces each.
LEAST_SHARES, SHARE_ROWS = 64, 50_000
#: Matches of at most so many characters are kept with their ids, at most so many per worker.
#: A match kept takes about 200 bytes, and an executor has a worker for each of its cores.
KEPT_CHARS = 48
KEPT_MATCHES = 200_000
#: What the classes of a pre-tokenizer's pattern hold of ASCII.
ASCII_CLASSES = {r"\p{L}": "a-zA-Z", r"\p{N}": "0-9"}


def byte_letters() -> dict[int, str]:
    """The letters that a byte-level tokenizer writes bytes with: printable ones for
    themselves, the others from U+0100 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {
        byte: chr(256 + place) for place, byte in enumerate(others)
    }


def ascii_matcher(pattern: str) -> re.Pattern | None:
    """The pattern for texts of ASCII only, which it cuts into the same matches, for the standard
    library, which takes less than half the time there; None if it has no such form."""
    parts, in_class = [], False
    for part in re.findall(r"\\p\{[LN]\}|\\.|.", pattern, re.DOTALL):
        if part in ASCII_CLASSES:
            part = ASCII_CLASSES[part] if in_class else f"[{ASCII_CLASSES[part]}]"
        elif part in "[]":
            in_class = part == "["
        parts.append(part)
    try:
        return re.compile("".join(parts), re.ASCII)
    except re.error:
        return None


class PieceIds(dict):
    """Match of the pattern -> its ids as little-endian 32-bit numbers. The pre-tokenizer
    encodes matches apart, so a text's ids are those its model gives its matches, in a row.
    encode() takes names of added tokens for ordinary text, encode_whole() for their ids, as the
    library does."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        super().__init__()
        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        self.added = {}
        for number, token in tokenizer.get_added_tokens_decoder().items():
            if token.single_word or token.lstrip or token.rstrip:
                raise ValueError(f"added token {token.content!r} takes its surroundings into account")
            self.added[token.content] = number.to_bytes(4, "little")
        # The longest of those that start at one place.
        names = map(regex.escape, sorted(self.added, key=len, reverse=True))
        self.cut = regex.compile(f"({'|'.join(names)})").split if self.added else None
        self.letters = byte_letters()
        self.findall = regex.compile(pattern).findall
        plain = ascii_matcher(pattern)
        self.findall_ascii = plain.findall if plain else self.findall

    def __missing__(self, match: str) -> bytes:
        written = match.encode().decode("latin-1").translate(self.letters)
        ids = b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(written)])
        if len(match) <= KEPT_CHARS:
            if len(self) >= KEPT_MATCHES:
                # The newer half goes: frequent matches came early.
                for _ in range(-(-len(self) // 2)):
                    self.popitem()
            self[match] = ids
        return ids

    def encode(self, text: str) -> bytes:
        matches = self.findall_ascii(text) if text.isascii() else self.findall(text)
        return b"".join(map(self.__getitem__, matches))

    def encode_whole(self, text: str) -> bytes:
        """The library's ids of a text: added tokens are cut out first, what stands between
        them is encoded by itself."""
        if not self.cut:
            return self.encode(text)
        parts = self.cut(text)
        if len(parts) == 1:
            return self.encode(text)
        # Every other part is an added token.
        return b"".join(
            self.added[part] if k % 2 else self.encode(part) for k, part in enumerate(parts)
        )


@cache
def piece_ids(path: str, pattern: str) -> PieceIds:
    return PieceIds(path, pattern)


def cut_documents(
    docs: DataFrame, tokenizer: str, pattern: str, capacity: int, end_id: int, with_ids: bool
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, salt (and ids) of every piece of every document.
    Salts deal pieces evenly, whatever they hold: they come from the place of the row."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    types += [pa.binary()] * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_ids(tokenizer, pattern)
        salt = zlib.crc32(str(TaskContext.get().partitionId()).encode())
        for batch in batches:
            rows = []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            ):
                ids = encoder.encode_whole(text or "") + end
                total = len(ids) // 4
                first = total % capacity or capacity
                bounds = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[4 * a : 4 * b]
                    salt = (salt + 1) & 0x7FFFFFFF
                    row = (doc_id, piece, a, b - a, zlib.crc32(part), salt)
                    rows.append((*row, part) if with_ids else row)
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, salt int"
    return map_batches(read, cut, schema + ", ids binary" * with_ids)


def two_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(how many sequences, the lengths each holds in descending order) for pieces of these
    lengths (length -> how many)."""
    left = {length: count for length, count in histogram.items() if count > 0}
    plan = []
    while left:
        lengths = sorted(left, reverse=True)
        held: list[int] = []
        gap = capacity
        for length in lengths:
            fit = min(left[length], gap // length)
            held += [length] * fit
            gap -= fit * length
        if gap and len(held) > 1:
            held = _two_for_the_smallest(held, gap, left)
        uses = {length: held.count(length) for length in held}
        many = min(left[length] // count for length, count in uses.items())
        plan.append((many, tuple(sorted(held, reverse=True))))
        for length, count in uses.items():
            left[length] -= many * count
            if not left[length]:
                del left[length]
    return plan


def _two_for_the_smallest(held: list[int], gap: int, left: dict[int, int]) -> list[int]:
    """The pieces with the smallest replaced by the two unpacked ones that leave the least
    gap, if they leave less than there is."""
    smallest = held[-1]
    room = gap + smallest
    rest = held[:-1]
    free = {}
    for length in left:
        spare = left[length] - rest.count(length)
        if spare > 0 and length <= room:
            free[length] = spare
    lengths = sorted(free)
    best, low, high = (smallest, None), 0, len(lengths) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > room:
            high -= 1
            continue
        if a + b > best[0] and (a != b or free[a] > 1):
            best = (a + b, (a, b))
        low += 1
    return rest + list(best[1]) if best[1] else held


def _slots(plan: list[tuple[int, tuple[int, ...]]]) -> list[tuple]:
    """(length, number of the first piece, pieces a sequence, first sequence, first offset) for
    each length in each kind of sequence."""
    taken: dict[int, int] = {}
    slots, sequence = [], 0
    for many, held in plan:
        offset = 0
        for length in dict.fromkeys(held):
            count = held.count(length)
            first = taken.get(length, 0)
            slots.append((length, first, count, sequence, offset))
            taken[length] = first + many * count
            offset += count * length
        sequence += many
    return slots


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    pattern: str,
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every
    document (doc_id, text); with_ids adds the ids themselves as little-endian 32-bit numbers.

    tokenizer: the file of the `tokenizers` library, which every worker has; pattern: its
    pre-tokenizer's.
    """
    spark = docs.sparkSession
    pieces = stored(
        cut_documents(docs, tokenizer, pattern, capacity, end_id, with_ids), "pieces"
    )
    # A share of a length is numbered by one task; more pieces make more shares.
    shares = max(LEAST_SHARES, -(-pieces.count() // SHARE_ROWS))
    pieces = pieces.withColumn("share", F.pmod(F.xxhash64("salt"), F.lit(shares)))
    counts = pieces.groupBy("length", "share").agg(F.count("*").alias("n"))
    in_order = Window.partitionBy("length").orderBy("share")
    before = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("length", "share", F.coalesce(before, F.lit(0)).alias("before"))
    histogram = {
        row["length"]: row["n"]
        for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    slots = spark.createDataFrame(
        _slots(two_fit_plan(histogram, capacity)),
        "length long, first long, count long, sequence long, offset long",
    )
    slots = slots.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("first", "count", "sequence", "offset"))).alias("slots")
    )
    own = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32")
    numbered = pieces.withColumn("own", F.row_number().over(own) - 1)
    placed = (
        # The pieces are dealt by length and share already. Slots are bounded by the capacity.
        numbered.join(first, ["length", "share"])
        .join(F.broadcast(slots), "length")
        .withColumn("number", F.col("before") + F.col("own"))
        .withColumn("slot", F.expr("element_at(filter(slots, s -> s.first <= number), -1)"))
    )
    along = F.col("number") - F.col("slot.first")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("slot.sequence") + F.floor(along / F.col("slot.count"))).alias("sequence_id"),
        (F.col("slot.offset") + along % F.col("slot.count") * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []),
    )
