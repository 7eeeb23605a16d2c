"""How the pairs of near_dedup grow with a group, and its tiles by themselves."""

import random

import numpy as np
import pyarrow as pa
import reference
from fixtures import docs_of  # noqa: F401

from wattledger.llm import near_dedup


def near_copies(count, words=150, seed=1):
    """Texts of one base with 1 to 5 words replaced: many pairs are links, many just aren't."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10_000)}" for _ in range(words)]
    rows = []
    for k in range(count):
        own = list(base)
        for place in rng.sample(range(words), rng.randrange(1, 6)):
            own[place] = f"c{k}x{place}"
        rows.append((k, " ".join(own)))
    return rows


def test_pairs_per_document_stay_flat(docs_of, monkeypatch):
    """Pairs whose texts are compared, and links that tiles hand on, for each document."""
    per_document = {}
    for count in (150, 600):
        made = []

        def counted(function, at):
            def run(*args):
                out = function(*args)
                made.append((at, out.count()))
                return out

            return run

        with monkeypatch.context() as patch:
            patch.setattr(near_dedup, "_promising", counted(near_dedup._promising, "pairs"))
            patch.setattr(near_dedup, "_across", counted(near_dedup._across, "links"))
            rows = near_copies(count)
            got = near_dedup.group_documents(docs_of(rows)).collect()
        assert sorted((tuple(r) for r in got), key=repr) == reference.components(rows)
        assert all(n <= count for _, n in made)
        per_document[count] = sum(n for _, n in made) / count
    assert max(per_document.values()) <= near_dedup.ROUNDS + 1
    assert per_document[600] <= 1.3 * per_document[150] + 0.2


def test_small_blocks_find_the_same_links(docs_of, monkeypatch):
    for name, value in (("BLOCK_ROWS", 3), ("BLOCK_SHINGLES", 1000), ("TILE_COLUMNS", 64), ("ROUNDS", 1)):
        monkeypatch.setattr(near_dedup, name, value)
    texts = near_copies(60, 80, 3) + [(100 + d, t) for d, t in near_copies(40, 400, 4)]
    got = near_dedup.group_documents(docs_of(texts)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == reference.components(texts)


def block(docs, labels, sets):
    held = [{"doc": d, "label": x, "shingles": np.array(sorted(s), np.uint64).tobytes()}
            for d, x, s in zip(docs, labels, sets)]
    kind = pa.struct([("doc", pa.int64()), ("label", pa.int64()), ("shingles", pa.binary())])
    return near_dedup.Block(pa.array(held, kind))


def test_a_tile_links_each_component_once():
    same = set(range(100, 200))
    one = block([1, 2, 3], [1, 2, 3], [same, same - {150}, {7, 2**63 + 5}])
    other = block([11, 12, 13], [11, 1, 13], [same | {999}, same, {7, 2**63 + 5, 8}])
    joined = near_dedup.Joined()
    assert (near_dedup.shared_shingles(one, other) == [[100, 100, 0], [99, 99, 0], [0, 0, 2]]).all()
    pairs = near_dedup.joining_links(one, other, joined)
    # 3 and 13 have 2 of 3 in common; 1, 2, 11 and 12 are three components.
    assert len(pairs) == 2 and {x for pair in pairs for x in pair} <= {1, 2, 11, 12}
    assert near_dedup.joining_links(one, other, joined) == []
    assert near_dedup.joining_links(other, one, near_dedup.Joined()) != []
