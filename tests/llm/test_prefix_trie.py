"""The trie of conversation prefixes, against a plain version and by its parts."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from wattledger.llm import prefix_trie


def cell(role, text):
    """What orders turns of one number."""
    whole = f"{len(role)}:{role}{text}".encode()
    return hashlib.sha256(whole).hexdigest()[:32] + f"{len(text.encode()):08X}"


def plain(rows):
    """(conv_id, turn, role, text) -> sorted node rows."""
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            order = (turn is not None, turn or 0, cell(role or "", text or ""))
            own.setdefault(conv_id, []).append((order, role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(turns)] for c, turns in own.items()}
    lists = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        lists[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:]
    members = {}
    for c, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)

    def subtree(prefix):
        todo, found = [prefix], []
        while todo:
            found.append(todo.pop())
            todo += children.get(found[-1], [])
        return found

    out = []
    for prefix, ids in members.items():
        below = subtree(prefix)
        ends = sorted(c for c in ids if len(lists[c]) == len(prefix))
        out.append((
            min(ids), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(ids),
            len(children.get(prefix, ())), sum(p not in children for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def turns_frame(spark, rows):
    rows = [(*row, 1, b"x", "d") for row in rows]
    schema = "conv_id long, turn long, role string, text string, depth int, cells binary, digest string"
    return spark.createDataFrame(rows, schema).repartition(3)


def got(spark, rows):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(turns_frame(spark, rows)).collect()), key=repr)


def some_conversations(rng, count, copies=0):
    rows = []
    for c in range(count):
        first = rng.randrange(3)
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"t{first if t < 2 else rng.randrange(2)}é"))
    # Copies: of one turn each and far more than a run holds.
    rows += [(5 * (1000 + k), 0, "user", "the same") for k in range(copies)]
    rng.shuffle(rows)
    return rows


ODD = [
    (None, 0, "user", "no id"), (5, None, "user", "null turn"), (5, 0, None, None), (5, 1, "user", ""),
    (6, 0, "", ""), (7, 0, "us", "er"), (8, 0, "use", "r"), (9, 0, "user", None), (-7, 0, "user", "x"),
    (-5, 0, "user", "base of -7"), (-5, 1, "assistant", "second"), (0, 0, "user", "zero"), (3, 0, "user", "zero"),
    (4, 2, "user", "y" * 70_000), (11, 0, "user", "a"), (11, 0, "user", "a"), (11, 0, "user", "a"),
    (2**62, 0, "user", "far"), (21, None, "a", "b"), (21, -3, "c", "d"),
] + [(12, k, "user", f"turn {k}") for k in range(300)]


def test_odd_conversations(spark):
    assert got(spark, ODD) == plain(ODD)
    assert got(spark, ODD * 2) == plain(ODD * 2)
    assert got(spark, []) == [] == got(spark, ODD[:1])
    assert got(spark, [(1, 0, "user", "short")]) == plain([(1, 0, "user", "short")])


@pytest.mark.parametrize("runs, ids", [(4096, 4096), (3, 2), (1, 1)])
def test_blocks_of_any_size_give_the_same_trie(spark, monkeypatch, runs, ids):
    monkeypatch.setattr(prefix_trie, "BLOCK_RUNS", runs)
    monkeypatch.setattr(prefix_trie, "RUN_IDS", ids)
    rows = some_conversations(random.Random(runs), 150, 70) + ODD
    assert got(spark, rows) == plain(rows)


def test_extents_search_each_for_itself():
    rng = np.random.default_rng(2)
    for count in (1, 2, 7, 64, 65):
        common = rng.integers(0, 4, count)
        common[0] = -1
        place = np.repeat(np.arange(count), 6)
        depth = np.tile(np.arange(6), count)
        left, right = prefix_trie.extents(prefix_trie.SparseTable(common), count, place, depth)
        for p, d, a, b in zip(place, depth, left, right):
            first = last = p
            while first > 0 and common[first] >= d:
                first -= 1
            while last + 1 < count and common[last + 1] >= d:
                last += 1
            assert (a, b) == (first, last)
