"""Blocks of rows: bounded runs of a scan that travel as one compressed Arrow payload.

Operators that look words or windows up in a corpus-wide table number what a
block holds, ship only the numbers or hashes, and meet the answers again at
the block. That keeps shuffles far below one row for each word.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 60_000


#: What modules keep in a worker between tasks of their own, each with a way to drop it.
KEPT: list[Callable[[], None]] = []


def give_back() -> None:
    """Drop what other operators' tasks left, and return freed memory to the system.

    A Python worker lives on after its task, and so would the memory.
    """
    for drop in KEPT:
        drop()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """The same work over batches, with memory given back before and after."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()

    return work


def text_bytes(column) -> list[bytes]:
    """The texts as UTF-8 bytes, null as empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def cut(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = BLOCK_BYTES, max_rows: int = BLOCK_ROWS) -> Iterator[pa.Table]:
    """Consecutive rows as tables of at most ``max_bytes`` of text (or one row) and ``max_rows`` rows.

    The cuts depend on rows and texts alone, not on how Arrow batches fall.
    """
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start = 0
        for i, n in enumerate(lengths.tolist()):
            if rows and (size + n > max_bytes or rows >= max_rows):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, size, rows, start = [], 0, 0, i
            size += n
            rows += 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def task_blocks(batches: Iterator[pa.RecordBatch], text: str, **limits) -> Iterator[tuple[int, pa.Table]]:
    """Blocks of this task with ids that are unique over all tasks of the scan."""
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 32
    for k, table in enumerate(cut(batches, text, **limits)):
        yield first + k, table


def to_ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def from_ipc(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()
