"""Byte-level BPE, encoded and decoded by tree reduction.

A text is cut into matches of the tokenizer's pattern, and each match is encoded by itself: its
halves are encoded by recursion, down to known tokens and single bytes, and then joined. Joining
encodes anew a window of tokens on both sides of the seam, and widens it until the window's
outermost tokens come out as they were. That proves the rest right: a sequence of tokens is the
encoding of its bytes exactly if every two neighbours are the encoding of theirs, and then
all neighbours outside the window, inside it and across its ends are neighbours in some right
encoding. The ids of matches are joined up the text's tree; no token crosses the end of a
match, so there nothing is encoded anew.

Decoding joins the bytes of tokens up the same kind of tree.

Matches repeat, so each task keeps the ids of short ones, a bounded number. Work is one row at
a time: nothing is shuffled.

A null text is encoded as the empty one; repeated rows are encoded each; an empty table gives
no rows. The encoder returns the columns it is asked to keep and `ids`, other columns are not
read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.workers import map_batches

#: Windows of so few bytes are merged by a list of ranks, longer ones by a heap: the same result.
LISTED_BYTES = 24
#: Matches of at most so many characters are kept, and at most so many of them.
KEPT_CHARS = 48
KEPT_MATCHES = 500_000
#: Encodings that are kept: of two tokens at a seam, and of parts of matches of so many bytes.
KEPT_SEAMS = 100_000
KEPT_PARTS, PART_BYTES = 100_000, 8
#: Neighbours that a node of a text's tree joins.
FAN_IN = 16
#: Above every rank: a pair that is no token.
NONE = 1 << 32
#: A text longer than this is matched piece by piece instead of into one list.
LISTED_CHARS = 1 << 20


def joined_up(parts: list[bytes]) -> bytes:
    """The parts in a row, by a tree of joins of FAN_IN neighbours."""
    while len(parts) > 1:
        parts = [b"".join(parts[k : k + FAN_IN]) for k in range(0, len(parts), FAN_IN)]
    return parts[0] if parts else b""


class TreeEncoder:
    """Ranks of byte strings -> the BPE encoding of any bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.strings = {rank: string for string, rank in ranks.items()}
        self.seams: dict[tuple[int, int], list[int]] = {}
        self.parts: dict[bytes, list[int]] = {}

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size = len(data)
        if size <= 2:
            return [self.ranks[data[k : k + 1]] for k in range(size)]
        known = self.parts.get(data)
        if known is not None:
            return known
        middle = size // 2
        left, right = self.encode(data[:middle]), self.encode(data[middle:])
        window = self.seams.get((left[-1], right[0]))
        if window is not None and window == [left[-1], right[0]]:
            ids = left + right
        else:
            ids = self.join(left, right)
        if size <= PART_BYTES:
            if len(self.parts) >= KEPT_PARTS:
                self.parts.clear()
            self.parts[data] = ids
        return ids

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encodings' bytes together."""
        if not left or not right:
            return left or right
        # The narrowest window, a token on both sides, is met again and again.
        window = self.seam(left[-1], right[0])
        a = b = width = 1
        while not (
            (a == len(left) or window[0] == left[len(left) - a])
            and (b == len(right) or window[-1] == right[b - 1])
        ):
            width *= 2
            a, b = min(width, len(left)), min(width, len(right))
            around = left[len(left) - a :] + right[:b]
            window = self.merge(b"".join(map(self.strings.__getitem__, around)))
        return left[: len(left) - a] + window + right[b:]

    def seam(self, left: int, right: int) -> list[int]:
        """The encoding of two tokens' bytes together."""
        found = self.seams.get((left, right))
        if found is None:
            if len(self.seams) >= KEPT_SEAMS:
                self.seams.clear()
            found = self.seams[left, right] = self.merge(self.strings[left] + self.strings[right])
        return found

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE: of all neighbours the pair of lowest rank is merged, the first of equals,
        until none has a rank. A heap holds the pairs, so long runs take n log n steps."""
        ranks = self.ranks
        if len(data) <= LISTED_BYTES:
            return self.merge_few(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(len(data))]
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        pairs = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts):
                rank = ranks.get(parts[i] + parts[j])
                if rank is not None:
                    heapq.heappush(pairs, (rank, i, len(parts[i]), len(parts[j])))

        for i in range(len(parts) - 1):
            offer(i)
        while pairs:
            _, i, left_size, right_size = heapq.heappop(pairs)
            if parts[i] is None or len(parts[i]) != left_size:
                continue
            j = after[i]
            if j >= len(parts) or len(parts[j]) != right_size:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ranks[part] for part in parts if part is not None]

    def merge_few(self, data: bytes) -> list[int]:
        """merge() for a few bytes: the pairs' ranks stand in a list."""
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], NONE) for i in range(len(data) - 1)]
        while pairs:
            least = min(pairs)
            if least == NONE:
                break
            at = pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], NONE)
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], NONE)
        return [self.ranks[part] for part in parts]

    def decode(self, ids: list[int]) -> bytes:
        return joined_up(list(map(self.strings.__getitem__, ids)))


class TextEncoder(dict):
    """Match -> its ids as little-endian 32-bit numbers; also encodes whole texts."""

    def __init__(self, ranks_path: str, pattern: str):
        super().__init__()
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tree = TreeEncoder(ranks)
        self.pattern = regex.compile(pattern)

    def __missing__(self, match: str) -> bytes:
        ids = b"".join(i.to_bytes(4, "little") for i in self.tree.encode(match.encode()))
        if len(match) <= KEPT_CHARS:
            if len(self) >= KEPT_MATCHES:
                self.clear()
            self[match] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if len(text) <= LISTED_CHARS:
            return joined_up(list(map(self.__getitem__, self.pattern.findall(text))))
        # A part of the matches at a time; the parts' ids are the leaves of the upper tree.
        matches = (m.group() for m in self.pattern.finditer(text))
        parts = iter(lambda: list(map(self.__getitem__, islice(matches, LISTED_CHARS // 8))), [])
        return joined_up([joined_up(part) for part in parts])

    def decode(self, ids: bytes) -> bytes:
        return self.tree.decode(np.frombuffer(ids, dtype="<u4").tolist())


@cache
def text_encoder(ranks_path: str, pattern: str) -> TextEncoder:
    """One per worker process and vocabulary."""
    return TextEncoder(ranks_path, pattern)


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The kept columns and `ids`: the tokens of `text` as little-endian unsigned 32-bit
    numbers. ranks_path: a file of base64 strings and ranks, which every worker has."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_path, pattern)
        for batch in batches:
            ids = [encoder.encode(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(ids, pa.binary())], names=[*keep, "ids"]
            )

    read = docs.select(*keep, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return map_batches(read, encode, f"{kept}, ids binary")


def decode_ids(
    encoded: DataFrame, ranks_path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The kept columns, `ids` and `decoded`: the bytes that the ids stand for."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_path, pattern)
        for batch in batches:
            texts = [encoder.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], names=[*keep, "ids", "decoded"]
            )

    read = encoded.select(*keep, "ids")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema)
    return map_batches(read, decode, f"{kept}, decoded binary").select(
        *keep, "ids", F.col("decoded")
    )
