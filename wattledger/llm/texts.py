"""Documents whose texts change while their other columns stay."""

from __future__ import annotations

import pyarrow as pa


def with_texts(
    batch: pa.RecordBatch, changed: dict[int, str], length: str | None = None
) -> pa.RecordBatch:
    """The batch with `text` replaced in some rows (row -> text) and, in these, the column
    `length` set to the text's code points."""
    new = {"text": changed}
    if length:
        new[length] = {row: len(text) for row, text in changed.items()}
    for name, values in new.items():
        at = batch.schema.get_field_index(name)
        field = batch.schema.field(at)
        column = batch.column(at).to_pylist()
        for row, value in values.items():
            column[row] = value
        batch = batch.set_column(at, field, pa.array(column, field.type))
    return batch
