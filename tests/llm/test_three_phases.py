"""That the phases of exact_topk do their part: bounds hold, and little is resolved."""

import numpy as np
from pyspark.sql import functions as F

from wattledger.llm import exact_topk


def frame(spark, vectors):
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)


def test_few_entries_are_named_and_fewer_resolved(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(2000, 32)) / 6
    seen = {}

    def counted(name):
        function = getattr(exact_topk, name)

        def run(*args):
            out = function(*args)
            seen[name] = args[0] if name == "_resolved" else (out, *args)
            return out

        monkeypatch.setattr(exact_topk, name, run)

    for name in ("_gathered", "_cutoffs", "_named", "_resolved"):
        counted(name)
    got = exact_topk.top_products(frame(spark, vectors), F.col("vec_id") % 50 == 0, 5).collect()
    whole = np.floor(256 * vectors).astype(np.int64)
    scores = whole[::50] @ whole.T
    for k in range(40):
        order = sorted((-s, i) for i, s in enumerate(scores[k].tolist()) if i != 50 * k)[:5]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 50 * k)
        assert own == [(n + 1, i, -minus) for n, (minus, i) in enumerate(order)]

    # The cutoff is one that the true answer reaches.
    cutoffs, _, lowest, _ = seen["_cutoffs"]
    base = {}
    for r in lowest.collect():
        base[r["query_id"]] = base.get(r["query_id"], 0) + r["lowest"]
    assert cutoffs.count() == 40
    for r in cutoffs.collect():
        fifth = np.sort(np.delete(scores[r["query_id"] // 50], r["query_id"]))[-5]
        assert r["cutoff"] + base[r["query_id"]] <= fifth
    # A node names by its own part alone; most entries are never named, and fewer resolved.
    pairs = 40 * 1999
    named = seen["_named"][0].select("query_id", "row").distinct().count()
    assert 200 <= named < pairs / 4
    resolved = seen["_resolved"].collect()
    assert 0 < len(resolved) < named
    assert all(len(r["held"]) == 16 for r in resolved)  # the missing node's half only
    assert seen["_gathered"][0].where("row is not null").count() < pairs / 2


def test_odd_lengths_are_dealt_whole(spark):
    """Vectors of 1, 3 and 5 components beside longer ones: each compared with its like."""
    rng = np.random.default_rng(4)
    vectors = [rng.normal(size=n) for n in (1, 3, 5, 5, 1, 3) * 20]
    got = exact_topk.top_products(frame(spark, vectors), F.col("vec_id") % 50 == 0, 3).collect()
    whole = [np.floor(256 * v).astype(np.int64) for v in vectors]
    for q in (0, 50, 100):
        found = sorted(
            (-int(whole[q] @ w), i) for i, w in enumerate(whole) if i != q and len(w) == len(whole[q])
        )[:3]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert own == [(n + 1, i, -minus) for n, (minus, i) in enumerate(found)]
