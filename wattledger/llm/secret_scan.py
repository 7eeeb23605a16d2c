"""Secrets in texts: fixed patterns, and the guess cost of what stands where credentials do.

Base spans are assignments to credential names, access keys and long hexadecimal runs. Beside
them, any value in a credential's place (`pwd: ...`, `passphrase is ...`; between quotes, all
up to the closing one on that line) is judged by what it would cost to guess: dynamic
programming finds its cheapest division into common words, dates, repeats, keyboard walks and
plain characters, any part of a longer walk or repeat included. A value that takes MIN_GUESSES or more is a
secret (`guess`); `password: required` is not. Common words are those of the corpus itself,
ranked over all its documents, after a short fixed list of passwords. What stands in a
credential's place is not counted: copies of a credential don't make it a common word.

Spans are in code points, end exclusive. A null text is empty and has none. Repeated rows are
scanned each; empty tables give no rows; other columns are not read. Time is linear in a
text's length: a value's cost takes steps in proportion to its length.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.stored import stored
from wattledger.llm.texts import with_texts
from wattledger.llm.workers import map_batches

#: In the order in which spans of equal start are listed.
KINDS = ("assign", "access", "hex", "guess")

# ASCII: else `ſ` and the Kelvin sign would count as letters of a name.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.ASCII)
HEX_RUN = re.compile(r"[0-9a-f]{24,}", re.ASCII)
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

CONTEXT = re.compile(
    r"""(?i:pass(?:word|wd|phrase|code|key)?|pwd|secret|token|api[_-]?key|credentials?|auth)"""
    r"""["']?\x20*(?::=|=>|[:=]|\x20is\x20)\x20*"""
    # Between quotes, of which escaped ones don't close unless there is no other.
    r"""(?:"(?!")([^"\\\r\n]*+(?:\\[^\r\n][^"\\\r\n]*+)*+)"|"([^"\r\n]+)\""""
    r"""|'(?!')([^'\\\r\n]*+(?:\\[^\r\n][^'\\\r\n]*+)*+)'|'([^'\r\n]+)'"""
    r"""|["']?([^\s"'<>,;]+))""",
    re.ASCII,
)
#: The group of a value without quotes around it.
BARE = 5

#: log10 of the guesses from which a value in a credential's place is taken for a secret.
MIN_GUESSES = 8.0
#: Words of the corpus in the dictionary, and the longest word looked up.
DICTIONARY_WORDS = 20_000
LONGEST_WORD = 24

# Common passwords and words for "nothing here" (fixed values).
PASSWORDS = (
    "password", "passwd", "secret", "token", "admin", "root", "login", "welcome", "letmein",
    "monkey", "dragon", "master", "qwerty", "iloveyou", "sunshine", "princess", "football",
    "baseball", "shadow", "superman", "batman", "trustno", "hello", "freedom", "whatever",
    "changeme", "default", "example", "sample", "test", "testing", "guest", "user", "username",
    "required", "optional", "none", "null", "true", "false", "undefined", "empty", "missing",
    "invalid", "incorrect", "wrong", "expired", "reset", "hidden", "redacted", "removed",
    "placeholder", "your", "here", "string", "value", "unknown", "forgotten", "protected",
)

#: Rows of keys that are walked along, and two other common orders (fixed values).
WALKS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")

_DAY, _MONTH, _CENTURY = r"(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|1[0-2])", r"(?:19|20)"
#: A year, and a date with its year first, last, or last in two digits: all that start somewhere.
YEAR = re.compile(rf"{_CENTURY}\d\d", re.ASCII)
DATES = (
    re.compile(rf"{_CENTURY}\d\d([-/._]?){_MONTH}\1{_DAY}", re.ASCII),
    re.compile(rf"{_DAY}([-/._]?){_MONTH}\1{_CENTURY}\d\d", re.ASCII),
    re.compile(rf"{_DAY}([-/._]?){_MONTH}\1\d\d", re.ASCII),
)
#: Days that a date or years that a year may be.
DATE_GUESSES, YEAR_GUESSES = math.log10(365 * 120), math.log10(120)

#: The longest part whose repeats count, and the fewest characters of a walk or of repeats.
LONGEST_UNIT = 16
LEAST_RUN = 3


class GuessCost:
    """log10 of the guesses a value takes."""

    def __init__(self, words: list[str]):
        """words: most common first."""
        ranked = dict.fromkeys([*PASSWORDS, *words])
        self.rank = {word: math.log10(place + 2) for place, word in enumerate(ranked)}
        self.steps: dict[str, set[str]] = {}
        for row in WALKS:
            for a, b in zip(row, row[1:]):
                self.steps.setdefault(a, set()).add(b)
                self.steps.setdefault(b, set()).add(a)

    @staticmethod
    def character(char: str) -> float:
        if char.isdigit():
            return 1.0
        if char.isalpha():
            return math.log10(26) if char.isascii() else math.log10(100)
        return math.log10(33)

    def words_and_dates(self, value: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, cost) of every word and date in the value."""
        lower = _lower(value)
        size = len(value)
        for start in range(size):
            for end in range(start + 3, min(size, start + LONGEST_WORD) + 1):
                word = lower[start:end]
                cost = self.rank.get(word)
                if cost is None:
                    cost = self.rank.get(word[::-1])
                if cost is not None:
                    cased = value[start:end] != word
                    yield start, end, cost + (math.log10(2) if cased else 0)
            if value[start].isdigit():
                year = YEAR.match(value, start)
                if year:
                    yield start, year.end(), YEAR_GUESSES
                for date in DATES:
                    found = date.match(value, start)
                    if found:
                        yield start, found.end(), DATE_GUESSES

    def cost(self, value: str, repeats: bool = True) -> float:
        """Of the cheapest division into spans and single characters: every word and date, every
        walk of LEAST_RUN keys or more, every part of at most LONGEST_UNIT characters that
        stands twice or more in a row (a part's own repeats don't count: they are a shorter
        part's)."""
        ending: dict[int, list[tuple[int, float]]] = {}
        for start, end, cost in self.words_and_dates(value):
            ending.setdefault(end, []).append((start, cost))
        lower = _lower(value)
        best = [0.0]
        walk = _Starts(_walk_guesses)
        units = range(1, min(LONGEST_UNIT, len(value) // 2) + 1) if repeats else ()
        # Of each unit, the starts of its repeats by where they stand within it, and the first
        # place from which on the value repeats itself at that distance.
        runs = {unit: [_Starts(math.log10) for _ in range(unit)] for unit in units}
        since = dict.fromkeys(units, 0)
        parts: dict[str, float] = {}
        for end in range(1, len(value) + 1):
            least = best[end - 1] + self.character(value[end - 1])
            for start, cost in ending.get(end, ()):
                least = min(least, best[start] + cost)
            if end > 1 and lower[end - 1] not in self.steps.get(lower[end - 2], ()):
                walk.clear()
            walk.add(end - 1, best[end - 1])
            least = min(least, walk.cheapest(end, 1, LEAST_RUN))
            for unit in units:
                if end > unit and value[end - 1] != value[end - 1 - unit]:
                    since[unit] = end - unit
                if end < unit:
                    continue
                starts = runs[unit][end % unit]
                if starts.drop_before(since[unit]):
                    least = min(least, starts.cheapest(end, unit, max(2 * unit, LEAST_RUN)))
                part = value[end - unit : end]
                if part not in parts:
                    parts[part] = self.cost(part, False)
                starts.add(end - unit, best[end - unit] + parts[part])
            best.append(least)
        return best[-1]


def _lower(value: str) -> str:
    lower = value.lower()
    return lower if len(lower) == len(value) else value


def _walk_guesses(size: float) -> float:
    """Any of 47 keys, either way, so many steps."""
    return math.log10(47 * 2 * size)


class _Starts:
    """Places where a run may start, first to last, and what a value costs up to there. A run's own
    cost grows ever slower with its length; so a start that costs no less than an earlier one
    at some end never will again, and is forgotten."""

    def __init__(self, guesses):
        self.guesses = guesses
        self.places: list[int] = []
        self.before: list[float] = []

    def clear(self) -> None:
        self.places.clear()
        self.before.clear()

    def add(self, place: int, before: float) -> None:
        self.places.append(place)
        self.before.append(before)

    def drop_before(self, place: int) -> int:
        """Forgets earlier starts; how many are left."""
        gone = bisect_left(self.places, place)
        if gone:
            del self.places[:gone], self.before[:gone]
        return len(self.places)

    def cheapest(self, end: int, unit: int, least: int) -> float:
        """Of the runs of at least `least` characters that end here."""
        lowest, kept = math.inf, 0
        for place, before in zip(self.places, self.before):
            size = end - place
            if size >= least:
                cost = before + self.guesses(size / unit)
                if cost >= lowest:
                    continue
                lowest = cost
            self.places[kept], self.before[kept] = place, before
            kept += 1
        del self.places[kept:], self.before[kept:]
        return lowest


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    for match in ASSIGN.finditer(text):
        if match.end(1) - match.start(1) >= LEAST_VALUE:
            found.append(("assign", match.start(), match.end()))
    for match in ACCESS.finditer(text):
        if match.end() - match.start() >= LEAST_ACCESS:
            found.append(("access", match.start(), match.end()))
    # Runs are greedy, so those of 24 and more are the ones that pass.
    for match in HEX_RUN.finditer(text):
        found.append(("hex", match.start(), match.end()))
    return found


def credential_values(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, quoted) of every value in a credential's place. What a quoted value holds
    may be such a place again."""
    at = 0
    while match := CONTEXT.search(text, at):
        start, end = match.span(match.lastindex)
        quoted = match.lastindex != BARE
        yield start, end, quoted
        at = start if quoted else end


def guess_spans(text: str, costs: GuessCost) -> list[tuple[str, int, int]]:
    found, covered = [], 0
    for start, end, quoted in credential_values(text):
        if end <= covered:
            continue
        value = text[start:end] if quoted else text[start:end].rstrip(".:!?)]}")
        if len(value) >= LEAST_VALUE and costs.cost(value) >= MIN_GUESSES:
            covered = start + len(value)
            found.append(("guess", start, covered))
    return found


def rest_of_values(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The whole of every quoted value that a span reaches into."""
    reach: list[tuple[int, int]] = []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        reach.append((start, max(end, reach[-1][1]) if reach else end))
    found = []
    for start, end, quoted in credential_values(text):
        before = bisect_left(reach, (end,)) - 1
        if quoted and before >= 0 and reach[before][1] > start:
            found.append(("value", start, end))
    return found


def listed(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind, joined by commas."""
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


WORD = re.compile(r"\b[^\W\d_]{3,24}\b")


def without_values(text: str) -> str:
    """The text with a space in place of everything that stands where credentials do."""
    spans = [("value", *match.span(1)) for match in ASSIGN.finditer(text)]
    spans += [("value", start, end) for start, end, _ in credential_values(text)]
    return redacted(text, spans, " ") if spans else text


def common_words(docs: DataFrame, count: int = DICTIONARY_WORDS) -> list[str]:
    """The corpus's `count` most frequent words of three letters and more, counted over all
    whole texts but for the values of credentials; equal counts in order of the word. What
    comes to the driver is bounded by `count`."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter[str] = Counter()
            for text in batch.column("text").to_pylist():
                if text:
                    words.update(WORD.findall(without_values(text).lower()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())],
                names=["word", "n"],
            )

    words = map_batches(docs.select("text"), counted, "word string, n long")
    words = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # How many words there are of each size of count, in eighths of a power of two: at most
    # 512 rows. They tell from where on all words are to be ranked.
    size = F.floor(F.log2("n") * 8)
    sizes = words.groupBy(size.alias("size")).agg(F.count("*").alias("words")).collect()
    least, there = 0, 0
    for row in sorted(sizes, key=lambda row: -row["size"]):
        least, there = row["size"], there + row["words"]
        if there >= count:
            break
    ranked = words.where(size >= least).orderBy(F.desc("n"), "word").limit(count)
    return [row["word"] for row in ranked.collect()]


def scan(docs: DataFrame, words: list[str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_assign, n_access, n_hex, n_guess, base_spans and spans (text as of
    listed()) for every row of docs."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = GuessCost(words)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                added = guess_spans(text, costs) if text else []
                number = Counter(kind for kind, _, _ in base + added)
                rows.append(
                    (*(number[kind] for kind in KINDS), listed(base), listed(base + added))
                )
            columns = list(zip(*rows)) if rows else [()] * (len(KINDS) + 2)
            types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, t) for c, t in zip(columns, types))],
                names=[*keep, *(f"n_{kind}" for kind in KINDS), "base_spans", "spans"],
            )

    read = docs.select(*keep, "text")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_batches(read, scanned, f"{kept}, {counts}, base_spans string, spans string")


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with every stretch that spans cover replaced by the mark."""
    pieces, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def redact_texts(
    docs: DataFrame, words: list[str], length: str | None = None, mark: str = "[SECRET]"
) -> DataFrame:
    """docs with every secret in `text` replaced by the mark, and with it the rest of a quoted
    value of which it is a part. Other columns and texts without
    secrets stay as they are, null texts too. length: a column that holds a text's code points,
    to be kept right where a text changes."""

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = GuessCost(words)
        for batch in batches:
            changed = {}
            texts = batch.column("text").to_pylist()
            for k, text in enumerate(texts):
                spans = base_spans(text) + guess_spans(text, costs) if text else []
                if spans:
                    spans += rest_of_values(text, spans)
                    changed[k] = redacted(text, spans, mark)
            yield with_texts(batch, changed, length)

    return map_batches(docs, cleaned, docs.schema)
