"""Arrow columns as bytes in tasks that work on whole texts."""

from __future__ import annotations

import pyarrow as pa


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL is empty."""
    return [text or b"" for text in batch.column(name).cast(pa.large_binary()).to_pylist()]


def inner_names(columns: list[str], named: tuple[str, ...] = ("text",)) -> dict[str, str]:
    """Names by position for columns that pass through a task, so that none clashes with its results."""
    return {name: name if name in named else f"c{number}" for number, name in enumerate(columns)}
