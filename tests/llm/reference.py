"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WHITE.findall(text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def kept_words(rows):
    """(doc_id, text) -> sorted (doc_id, n_words, n_removed, kept_sha256)."""
    first = {}
    for doc_id, text in rows:
        own = words(text)
        for i in range(len(own) - 12):
            if doc_id is not None:
                window = tuple(own[i : i + 13])
                first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        own = words(text)
        gone = set()
        for i in range(len(own) - 12):
            if doc_id is not None and first[tuple(own[i : i + 13])] < doc_id:
                gone.update(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc_id, len(own), len(gone), sha(kept)))
    return sorted(out, key=repr)


def shingles(text):
    own = words((text or "").translate(LOWER))
    if len(own) < 5:
        return frozenset([tuple(own)] if own else [])
    return frozenset(tuple(own[i : i + 5]) for i in range(len(own) - 4))


def components(rows):
    """(doc_id, text) -> sorted (doc_id, n_shingles, component_id, kept); distinct ids."""
    sets = {doc_id: shingles(text) for doc_id, text in rows if doc_id is not None}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for doc_id, own in sets.items():
        for shingle in own:
            holders[shingle].add(doc_id)
    pairs = {(a, b) for group in holders.values() for a in group for b in group if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    out = [(d, len(s), root(d), root(d) == d) for d, s in sets.items()]
    out += [(None, len(shingles(t)), None, True) for d, t in rows if d is None]
    return sorted(out, key=repr)


def base_spans(text):
    text = text or ""
    found = []
    for m in re.finditer(
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        text,
    ):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for order, kind, pattern, least in (
        (1, "access", r"AKIA[A-Z0-9]+", 20), (2, "hex", r"[0-9a-f]+", 24),
    ):
        for m in re.finditer(pattern, text):
            if len(m[0]) >= least:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [span for _, _, span in sorted(found)]


def pieces(ids, capacity):
    first = len(ids) % capacity or capacity
    bounds = [0, *range(first, len(ids) + 1, capacity)]
    return [
        (k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
        for k, (a, b) in enumerate(zip(bounds, bounds[1:]))
    ]
