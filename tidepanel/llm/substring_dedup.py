"""Substring dedup by Rabin-Karp hashes of every fixed-length word window.

A word covered by a window whose word sequence also starts in a document with
a smaller id is removed. Windows are judged on the input.

1. Each block of documents hashes every window (a polynomial of 64-bit word
   hashes, modulo 2^64), sorts the hashes and settles what it can alone: where
   a smaller document of the block has the same window. Of each hash only the
   smallest document's windows travel, so a hot passage is one entry a block.
2. Hash partitions count windows over all blocks: they find the smallest
   document of each hash and answer a bit for each window they got, in the
   order in which the block sent them, so no window is ever named twice. A
   partition works through its hash range in buckets of bounded size.
3. The block hashes again, reads the bits, and merges covered windows into
   maximal intervals to remove.

A block sends one row to each partition. With B blocks of 3 MB and P partitions
(one for each 48 MB of text, and at least the shuffle partitions) that is B x P
rows; a window in them takes ten bytes or so in the first shuffle and one bit
in the second, beside one compressed copy of the documents. A row has some 100
bytes of its own and 17 for each bucket, which counts where its windows are
few: a block has half a million windows, so from some 5,000 partitions
(240 GB) on a row holds 100 windows or fewer and its own bytes reach a tenth of
theirs; at 20 TB they are alike. Larger blocks (``BLOCK_TEXT``) and partitions
(``PART_TEXT``) move that point, for memory.

Two different windows with one 64-bit hash would be taken for equal: for n
windows that happens about n^2 / 2^65 times in the whole corpus.

Null text has no words. A text of any length is whole in one block, of its own
where it is longer than a block; its task takes some 20 times its size. Null
ids count as larger than every id, and nothing is removed for another null id.
Repeated rows share an id, so they take nothing from one another. Texts with
fewer words than a window stay whole. Empty tables give empty results. Extra
columns pass through ``remove``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import from_ipc, give_back, task_blocks, text_bytes, to_ipc
from .tables import drop, materialize, repeatable_scans, shuffle_partitions, unused

WINDOW_WORDS = 13
#: Bytes of text for which a partition is made, whose windows (ten bytes each) a task holds,
#: and for which a bucket is made, whose windows (some 40 bytes each) a task sorts at once.
PART_TEXT = 48 << 20
BUCKET_TEXT = 3 << 20
BLOCK_TEXT = 3 << 20
_BASE = 0x9E3779B97F4A7C15
_NO_ID = np.iinfo(np.int64).max


def window_hashes(words: np.ndarray, window: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows over 64-bit word hashes, scrambled to spread over buckets."""
    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, length = words, 1
    total, size = None, 0
    # Windows of 1, 2, 4, ... words; those in the binary digits of ``window`` are put together.
    while True:
        shift = np.uint64(pow(_BASE, length, 1 << 64))
        if window & length:
            if total is None:
                total = power
            else:
                m = min(len(total), len(power) - size)
                total = total[:m] * shift + power[size : size + m]
            size += length
        if 2 * length > window:
            break
        power = power[:-length] * shift + power[length:]
        length *= 2
    total = total[:n].copy()
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    return total


class Windows:
    """The windows of a block, sorted by hash; ``own`` are those that travel."""

    def __init__(self, table: pa.Table, text: str, id_column: str, window: int):
        self.words = [t.split() for t in text_bytes(table.column(text))]
        counts = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.firsts = np.cumsum(counts) - counts
        self.total = int(counts.sum())
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(self.words)), np.uint64, self.total)
        self.check = zlib.crc32(hashes.tobytes())
        found = window_hashes(hashes, window)
        del hashes
        left = np.repeat(self.firsts + counts, counts)[: len(found)] - np.arange(len(found))
        self.starts = np.flatnonzero(left >= window)
        ids = table.column(id_column).to_numpy()
        ids = np.array([_NO_ID if i is None or i != i else int(i) for i in ids.tolist()], np.int64) if ids.dtype != np.int64 else ids
        docs = np.repeat(ids, counts)[self.starts]
        found = found[self.starts]
        order = np.argsort(found, kind="stable")
        self.starts, self.hashes, self.docs = self.starts[order], found[order], docs[order]
        if len(order):
            group = np.concatenate(([0], np.cumsum(self.hashes[1:] != self.hashes[:-1])))
            lowest = np.minimum.reduceat(self.docs, np.flatnonzero(np.diff(group, prepend=-1)))
            self.covered = self.docs > lowest[group]
        else:
            self.covered = np.zeros(0, bool)
        self.own = np.flatnonzero(~self.covered)

    def buckets(self, n: int) -> np.ndarray:
        """The bucket of each window that travels: equal ranges of the hash, in order."""
        return (self.hashes[self.own] // np.uint64(-(-(1 << 64) // n))).astype(np.int64)


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values in as few bytes each as the largest needs, the width first."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _widen(payload: bytes, n: int, at: int) -> tuple[np.ndarray, int]:
    width = payload[at]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(payload, np.uint8, n * width, at + 1).reshape(n, width)
    return out.view("<u8").reshape(n), at + 1 + n * width


_SENT = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("check", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])


def _encoded(hashes: np.ndarray, docs: np.ndarray) -> bytes:
    """A bucket's windows of one block: sorted hashes as differences, documents as distances from the smallest."""
    if not len(hashes):
        return b""
    low = int(docs.min())
    away = docs.astype(np.uint64) - np.uint64(low & (1 << 64) - 1)
    return np.array([hashes[0]], "<u8").tobytes() + np.array([low], "<i8").tobytes() + _narrow(np.diff(hashes, prepend=hashes[:1])) + _narrow(away)


def _decoded(payload: bytes, n: int, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    first, low = np.frombuffer(payload, "<u8", 1, at)[0], np.frombuffer(payload, "<i8", 1, at + 8)[0]
    deltas, at = _widen(payload, n, at + 16)
    away, at = _widen(payload, n, at)
    return np.cumsum(deltas, dtype=np.uint64) + first, (away + low.astype(np.uint64)).astype(np.int64), at


def _send(text: str, id_column: str, window: int, parts: int, each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each partition with windows: how many each of its ``each`` buckets has, then the buckets."""
        for block, table in task_blocks(batches, text, max_bytes=BLOCK_TEXT):
            w = Windows(table, text, id_column, window)
            del table
            bucket = w.buckets(parts * each)
            hashes, docs, check = w.hashes[w.own], w.docs[w.own], w.check
            del w
            rows: list[dict] = []
            for part in np.unique(bucket // each).tolist():
                edges = np.searchsorted(bucket, np.arange(part * each, (part + 1) * each + 1))
                buckets = b"".join([_encoded(hashes[a:b], docs[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)])
                rows.append({"part": part, "block": block, "check": check, "n": int(edges[-1] - edges[0]), "payload": np.diff(edges).astype("<u4").tobytes() + buckets})
                if len(rows) == 64:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SENT)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SENT)
            del hashes, docs, bucket, rows
            give_back()

    return run


_ANSWERS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("check", pa.int64()), ("n", pa.int64()), ("payload", pa.binary())])
_ANSWERS_DDL = "block long, part int, check long, n long, payload binary"
#: In place of a partition: the texts of a block, which come after its answers.
_TEXTS = np.iinfo(np.int32).max


def _seen_before(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether a smaller document has the window too."""
    order = np.argsort(hashes, kind="stable")
    sorted_h, sorted_d = hashes[order], docs[order]
    group = np.concatenate(([0], np.cumsum(sorted_h[1:] != sorted_h[:-1])))
    lowest = np.minimum.reduceat(sorted_d, np.flatnonzero(np.diff(group, prepend=-1)))
    seen = np.empty(len(hashes), bool)
    seen[order] = sorted_d > lowest[group]
    return seen


def _answers(rows: list[dict], each: int) -> Iterator[pa.RecordBatch]:
    """For every row of a partition a bit for each of its windows, bucket by bucket."""
    counts = [np.frombuffer(r["payload"], "<u4", each).tolist() for r in rows]
    at = [4 * each] * len(rows)
    bits: list[list[np.ndarray]] = [[] for _ in rows]
    for bucket in range(each):
        found, hashes, docs = [], [], []
        for k, row in enumerate(rows):
            if n := counts[k][bucket]:
                h, d, at[k] = _decoded(row["payload"], n, at[k])
                found.append((k, n))
                hashes.append(h)
                docs.append(d)
        if not found:
            continue
        seen, first = _seen_before(np.concatenate(hashes), np.concatenate(docs)), 0
        for k, n in found:
            bits[k].append(seen[first : first + n])
            first += n
    for row, own in zip(rows, bits, strict=True):
        seen = np.concatenate(own)
        if seen.any():
            answer = {"block": row["block"], "part": row["part"], "check": row["check"], "n": row["n"], "payload": zstandard.compress(np.packbits(seen).tobytes())}
            yield pa.RecordBatch.from_pylist([answer], schema=_ANSWERS)


def _count(each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by partition; a partition's windows are counted together."""
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["part"] != row["part"]:
                    yield from _answers(held, each)
                    held = []
                held.append(row)
        if held:
            yield from _answers(held, each)
        held = []
        give_back()

    return run


def _ship(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table in task_blocks(batches, text, max_bytes=BLOCK_TEXT):
            row = {"block": block, "part": _TEXTS, "check": 0, "n": table.num_rows, "payload": to_ipc(table)}
            yield pa.RecordBatch.from_pylist([row], schema=_ANSWERS)

    return run


def _intervals(w: Windows, answers: list[dict], parts: int, each: int, window: int) -> np.ndarray:
    """A mark for each word of the block that goes."""
    part = w.buckets(parts * each) // each
    for row in answers:
        start, end = np.searchsorted(part, [row["part"], row["part"] + 1]).tolist()
        if row["check"] != w.check or end - start != row["n"]:
            raise RuntimeError("the table changed between two scans")
        bits = np.unpackbits(np.frombuffer(zstandard.decompress(row["payload"]), np.uint8), count=row["n"]).astype(bool)
        w.covered[w.own[start:end][bits]] = True
    starts = w.starts[w.covered]
    steps = np.zeros(w.total + 1, np.int64)
    steps[starts] += 1
    steps[starts + window] -= 1
    return np.cumsum(steps[:-1]) > 0


def _apply(text: str, id_column: str, window: int, parts: int, each: int, digest: bool, removed: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block, a block's answers before its documents."""
        block, answers = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block:
                    block, answers = row["block"], []
                if row["part"] != _TEXTS:
                    answers.append(row)
                    continue
                table = from_ipc(row["payload"])
                w = Windows(table, text, id_column, window)
                gone = _intervals(w, answers, parts, each, window)
                answers = []
                n_words, n_removed, kept = [], [], []
                before = table.column(text).to_pylist() if not digest else None
                for k, (first, words) in enumerate(zip(w.firsts.tolist(), w.words, strict=True)):
                    mine = gone[first : first + len(words)]
                    lost = int(mine.sum())
                    n_words.append(len(words))
                    n_removed.append(lost)
                    if digest:
                        left = words if not lost else [x for x, g in zip(words, mine.tolist(), strict=True) if not g]
                        kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
                    elif lost:
                        kept.append(b" ".join([x for x, g in zip(words, mine.tolist(), strict=True) if not g]).decode("utf-8", "replace"))
                    else:
                        kept.append(before[k])
                if digest:
                    out = [table.column(id_column).combine_chunks(), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
                    arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in out]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256"])
                else:
                    cols = [pa.array(kept, pa.string()) if n == text else table.column(n).combine_chunks() for n in table.column_names]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(n_removed, pa.int64())], names=[*table.column_names, removed])
                del table, w, gone, kept, before
                give_back()

    return run


def _run(docs: DataFrame, window: int, text: str, id_column: str, digest: bool) -> DataFrame:
    spark = docs.sparkSession
    hashed = docs.select(F.col(id_column).cast("long").alias("_doc"), F.col(text).alias("_text"))
    d, t, removed = unused(docs.columns, "_doc", "_text", "_removed")
    shipped = docs.select(F.col(id_column).cast("long").alias(d), F.col(text).alias(t), *([] if digest else [c for c in docs.columns if c != text]))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // PART_TEXT))
    each = max(1, -(-size // (parts * BUCKET_TEXT)))
    with repeatable_scans(spark):
        sent = hashed.mapInArrow(_send("_text", "_doc", window, parts, each), "part int, block long, check long, n long, payload binary")
        counted = sent.repartitionById(parts, F.col("part")).sortWithinPartitions("part").mapInArrow(_count(each), _ANSWERS_DDL)
        answers = materialize(counted, "windows")
        blocks = shipped.mapInArrow(_ship(t), _ANSWERS_DDL)
        # Blocks come first in the union: their ids are made from the task's place in the scan.
        joined = blocks.unionByName(answers).repartition(parts, "block").sortWithinPartitions("block", "part")
        if digest:
            schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
        else:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shipped.schema.fields) + f", `{removed}` long"
        out = materialize(joined.mapInArrow(_apply(t, d, window, parts, each, digest, removed), schema), "substring")
        drop(answers)
    return out


def removals(docs: DataFrame, window: int = WINDOW_WORDS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by blanks) of every row.

    ``docs`` must be a table as read (projected or filtered at most): it is
    read three times, once for its size, and a checksum of each block guards against changes between.
    """
    return _run(docs, window, text, id_column, True)


def remove(docs: DataFrame, window: int = WINDOW_WORDS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with repeated windows taken out of their texts.

    A text that loses nothing stays as it is, white space included; of others
    the kept words are joined by blanks. No row is dropped, all columns stay.
    """
    out = _run(docs, window, text, id_column, False)
    (kept,) = unused(docs.columns, "_text")
    return out.select(*(F.col(kept).alias(c) if c == text else F.col(c) for c in docs.columns))
