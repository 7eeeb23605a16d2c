"""Files that change, go and come back, as folders of real files."""

import os

import pytest

from wattledger.operators import elements as E
from wattledger.sources import versions as V
from wattledger.streaming.sinks import read_batches

GAS = "bill_type=gas/vendor_id=MGU001"


@pytest.fixture
def place(tmp_path):
    return f"{tmp_path}/files", f"{tmp_path}/log", f"{tmp_path}/elements"


def put(root, name, text, at):
    path = os.path.join(root, GAS, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write(text)
    os.utime(path, (1_700_000_000 + at,) * 2)
    return path


def changes(spark, log, number):
    rows = V.read_log(spark, log).where(f"batch_id = {number}").collect()
    return {os.path.basename(r.file_path): r.change for r in rows}


def test_only_what_changed_is_parsed_again_and_old_rows_are_closed(spark, place):
    root, log, elements = place
    one, two = put(root, "a.pdf", "first\nsecond", 1), put(root, "b.pdf", "stays", 1)
    put(root, "c.pdf", "goes and returns", 1)

    def step(number):
        V.snapshot_folder(spark, root, number, log)
        return V.parse_snapshot(spark, root, number, log, elements, E.parse_lines)

    assert step(1) == 4 and changes(spark, log, 1) == {"a.pdf": "ADDED", "b.pdf": "ADDED", "c.pdf": "ADDED"}
    put(root, "a.pdf", "other text", 2)
    os.remove(os.path.join(root, GAS, "c.pdf"))
    assert step(2) == 1 and changes(spark, log, 2) == {"a.pdf": "CHANGED", "c.pdf": "DELETED"}
    put(root, "c.pdf", "goes and returns", 1)
    assert step(3) == 1 and changes(spark, log, 3) == {"c.pdf": "RETURNED"}
    # Nothing new, and the second snapshot taken again, as it would be after a stop.
    assert step(4) == 0 and changes(spark, log, 4) == {}

    versions = {
        (os.path.basename(r.file_path), r.version): (r.change, r.valid_from, r.valid_to, r.ended_by)
        for r in V.file_versions(V.read_log(spark, log)).collect()
    }
    assert versions == {
        ("a.pdf", 1): ("ADDED", 1, 2, "CHANGED"), ("a.pdf", 2): ("CHANGED", 2, None, None),
        ("b.pdf", 1): ("ADDED", 1, None, None), ("c.pdf", 1): ("ADDED", 1, 2, "DELETED"),
        ("c.pdf", 2): ("RETURNED", 3, None, None),
    }
    rows = V.element_versions(read_batches(spark, elements), V.read_log(spark, log)).collect()
    current = sorted((os.path.basename(r.file_path), r.content) for r in rows if r.valid_to is None)
    assert current == [("a.pdf", "other text"), ("b.pdf", "stays"), ("c.pdf", "goes and returns")]
    assert len(rows) == 6 and os.path.exists(one) and os.path.exists(two)


def test_snapshot_taken_again_logs_the_same(spark, place):
    root, log, _ = place
    put(root, "a.pdf", "x", 1)
    for _ in range(2):
        assert V.snapshot_folder(spark, root, 1, log) == 1
    put(root, "a.pdf", "xy", 1)  # longer, with the same time
    for _ in range(2):
        assert V.snapshot_folder(spark, root, 2, log) == 1
    assert changes(spark, log, 1) == {"a.pdf": "ADDED"} and changes(spark, log, 2) == {"a.pdf": "CHANGED"}
    # Empty again: the replayed snapshot loses its row.
    put(root, "a.pdf", "x", 1)
    assert V.snapshot_folder(spark, root, 2, log) == 0 and changes(spark, log, 2) == {}
