"""Hard negatives against brute force, and the R-tree's bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattledger.llm import hard_negatives


def usable(vector):
    return bool(vector) and all(x is not None and np.isfinite(256.0 * x) for x in vector)


def product(a, b):
    exact = sum(x * y for x, y in zip(a, b))
    return min(max(exact, hard_negatives.LOWEST), hard_negatives.HIGHEST)


def plain(rows, anchors, positives=5, negatives=3, low=50, high=95):
    """(vec_id, vector, label) -> sorted result rows."""
    good = {
        (i, label, tuple(int(np.floor(np.float64(256) * x)) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and usable(v)
    }
    out = []
    for anchor in {i for i, _, _ in good if anchors(i)}:
        _, label, own = min(row for row in good if row[0] == anchor)
        scored = [(-product(own, v), i, la == label) for i, la, v in good if i != anchor and len(v) == len(own)]
        for minus, positive, _ in sorted(s for s in scored if s[2])[:positives]:
            fits = sorted(s for s in scored if not s[2] and low * -minus <= 100 * -s[0] <= high * -minus)
            out += [(anchor, positive, k + 1, i, -minus, -s) for k, (s, i, _) in enumerate(fits[:negatives])]
    return sorted(out)


def frame(spark, rows):
    rows = [(*row, 1, 2.0, "w") for row in rows]
    schema = "vec_id long, embedding array<double>, label int, rank int, score double, window string"
    return spark.createDataFrame(rows, schema).repartition(3)


def got(spark, rows, anchors, **options):
    mined = hard_negatives.mine(frame(spark, rows), anchors, **options)
    assert mined.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in mined.collect())


def odd_rows():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(4, 6))
    rows = [(k, (centres[k % 4] + rng.normal(size=6)).tolist(), int(rng.integers(0, 4))) for k in range(400)]
    hot = centres[0].tolist()
    rows += [(1000 + k, hot, 0) for k in range(500)] + [(2000 + k, hot, 1) for k in range(300)]
    rows += [(3000, None, 1), (3050, [], 1), (3100, [0.0] * 6, 1), (3150, [1.0, None] + [0.0] * 4, 1),
             (3200, [float("nan")] + [1.0] * 5, 1), (3250, [float("inf")] + [1.0] * 5, 1), (None, hot, 0),
             (3300, [1e307] * 6, 0), (3350, hot, None), (3400, [1.0, 2.0], 3), (3401, [2.0, 1.0], 3),
             (3402, [1.5, 1.0], 2), (3450, [-x for x in hot], 0), (0, rows[4][1], 2), (50, rows[50][1], rows[50][2]),
             (7, rows[8][1], 1), (7, rows[8][1], 1)]
    return rows


@pytest.mark.parametrize("leaf, fanout, tree", [(64, 8, 4096), (4, 3, 100), (1, 2, 7)])
def test_equals_brute_force(spark, monkeypatch, leaf, fanout, tree):
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", leaf)
    monkeypatch.setattr(hard_negatives, "FANOUT", fanout)
    monkeypatch.setattr(hard_negatives, "TREE_ROWS", tree)
    rows = odd_rows()
    assert got(spark, rows, F.col("vec_id") % 50 == 0) == plain(rows, lambda i: i % 50 == 0)


def test_other_windows_and_lists(spark):
    rows = odd_rows()[:300]
    options = {"positives": 2, "negatives": 9, "low": -30, "high": 120}
    expected = plain(rows, lambda i: i < 20, **options)
    assert expected and got(spark, rows, F.col("vec_id") < 20, **options) == expected


def test_products_beyond_doubles(spark):
    rows = [(0, [2.0**40, 1.0], 1), (1, [16.0, 3.0], 1), (2, [12.0, 1.0], 2), (3, [2.0**40, 0.0], 1),
            (4, [-(2.0**40), 0.0], 2), (5, [2.0**35, 1.0], 2), (6, [12.0, 0.5], 2), (7, [15.2, 2.85], 3)]
    assert got(spark, rows, F.col("vec_id") == 0) == plain(rows, lambda i: i == 0)


def test_no_rows(spark):
    assert got(spark, [], F.col("vec_id") == 0) == []
    assert got(spark, [(0, [1.0], 1)], F.col("vec_id") == 0) == []
    assert got(spark, [(0, [1.0], 1), (1, [1.0], 1)], F.col("vec_id") == 0) == []


def made_queries(rng, count, dim, label=0):
    vectors = rng.integers(-300, 300, (count, dim)).astype(float)
    windows = np.column_stack([np.full(count, -(10**6)), np.full(count, 10**6), np.zeros(count)])
    return hard_negatives.Queries({
        "dim": dim, "q_ids": np.arange(count).astype(np.int64).tobytes(),
        "q_labels": np.full(count, label, np.int64).tobytes(), "q_numbers": vectors.tobytes(),
        "q_windows": windows.astype(np.int64).tobytes(),
    })


def test_boxes_hold_their_rows_and_products(spark):
    rng = np.random.default_rng(3)
    numbers = rng.integers(-300, 300, (1500, 5)).astype(float)
    tree = hard_negatives.Tree(np.arange(1500), rng.integers(0, 3, 1500), numbers)
    tree = hard_negatives.Tree.read(tree.row(0))
    assert sorted(tree.ids) == list(range(1500)) and np.diff(tree.bounds).max() <= hard_negatives.LEAF_ROWS
    assert [level.shape[1] for level in tree.levels][-1] == 1
    queries = made_queries(rng, 20, 5)
    least, greatest = hard_negatives.intervals(queries, tree.levels[0])
    for box, (a, b) in enumerate(zip(tree.bounds, tree.bounds[1:])):
        found = queries.numbers @ tree.numbers[a:b].T
        assert (found >= least[:, [box]]).all() and (found <= greatest[:, [box]]).all()


def test_few_leaves_are_opened_where_boxes_tell(spark):
    """Clusters far apart: the best rows of a query are found without opening most leaves."""
    rng = np.random.default_rng(4)
    numbers = rng.integers(-300, 300, (4096, 2)).astype(float)
    tree = hard_negatives.Tree(np.arange(4096) + 100, np.zeros(4096, np.int64), numbers)
    lists = hard_negatives.Lists(5)
    opened = hard_negatives.search(tree, made_queries(rng, 1, 2), True, lists)
    assert opened < len(tree.bounds) / 4
    assert len(lists.heaps[(0, 0)]) == 5


def test_copies_of_blocks_are_never_broadcast(spark, sf_dir):
    """Blocks of queries and trees are there once for each row or column of the grid, which the
    estimates by which Spark broadcasts a table leave out."""
    from conftest import plan_text

    import __spark_entry__ as driver

    for name in ("op3_vector_search", "op11_hard_negatives"):
        assert "Broadcast" not in plan_text(driver.queries()[name](spark, sf_dir)), name
