"""SimHash near-dedup with pigeonhole blocks.

Fingerprints are 64-bit SimHashes of 3-word shingles. Documents with one
fingerprint are one class from the start, so exact copies cost one row. A
fingerprint is cut into six parts; two fingerprints that differ in at most
three bits agree in at least three whole parts, so they meet in one of the 20
tables keyed by three parts (some 32 bits, so chance meetings stay rare at any
size). Inside a bucket, Hamming distances are verified exactly and only the
edges of a spanning forest are kept: links that hold a class together, never
all pairs. A bucket of more than ``CHUNK`` fingerprints is dealt out as pairs
of chunks, so no task holds a whole hot bucket.

Component ids come from connected components over those edges; ties don't arise,
as ids are minima. Tables that grow with the documents are merged, never
broadcast, whatever the size of their files. Texts of any length are read whole, in memory of some 20
times a text's size. A fingerprint of very many rows meets its class in a join
that adaptive execution splits; its rows are never grouped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import slices, text_bytes, tidy
from .components import connected_components
from .tables import materialize, shuffle_partitions, unused

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
CHUNK = 4096


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The SimHash of a UTF-8 text; zero when it has no word."""
    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= words:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
        starts = [0, *ends[:-words].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], seed) for s, e in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]
    n = len(hashes)
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    whole = n // 255 * 255
    ones = bits[whole:].sum(0, dtype=np.int64)
    if whole:
        ones += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _add_fingerprints(text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                prints = np.fromiter(map(fingerprint, text_bytes(part.column(text))), np.uint64, part.num_rows)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(prints.view(np.int64))], names=[*names, "_fp"])

    return run


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and the fingerprint as a signed 64-bit _fp."""
    own = docs.select(*keep, *([text] if text not in keep else []))
    schema = ", ".join(f"`{c}` {own.schema[c].dataType.simpleString()}" for c in keep)
    return own.mapInArrow(tidy(_add_fingerprints(text, keep)), f"{schema}, _fp long")


def _parts(max_bits: int) -> list[tuple[int, int]]:
    """Shift and width of the parts: twice as many as bits may differ."""
    n = 2 * max_bits
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _keys(max_bits: int):
    parts = _parts(max_bits)
    out = []
    for k, some in enumerate(combinations(range(len(parts)), len(parts) - max_bits)):
        mask = sum(((1 << parts[i][1]) - 1) << parts[i][0] for i in some)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        out.append(F.struct(F.lit(k).alias("t"), F.col("_fp").bitwiseAND(F.lit(signed)).alias("k")))
    return F.explode(F.array(*out))


def _forest(prints: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between rows a and rows b (positions in prints).

    A breadth-first search that compares each row once with the rows of the
    other side not reached yet; a and b are the same rows or have none in common.
    """
    same = len(a) == len(b) and bool((a == b).all())
    left = [a, b]
    edges = []
    while len(left[0]):
        queue = [(int(left[0][0]), 0)]
        left[0] = left[0][1:]
        if same:
            left[1] = left[0]
        while queue:
            p, side = queue.pop()
            other = 0 if same else 1 - side
            rest = left[other]
            if not len(rest):
                continue
            near = np.bitwise_count(prints[rest] ^ prints[p]) <= max_bits
            if near.any():
                found = rest[near].tolist()
                left[other] = rest[~near]
                edges.extend((p, q) for q in found)
                queue.extend((q, other) for q in found)
    return edges


def _verify(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by t, k, i, j; a group of these is at most two chunks."""
        held: list[list[np.ndarray]] = []

        def groups(cols: list[np.ndarray]) -> Iterator[tuple[int, int]]:
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
            edges = [0, *change.tolist(), len(cols[0])]
            return zip(edges, edges[1:], strict=False)

        def edges_of(cols, start, end):
            prints = cols[4][start:end].view(np.uint64)
            chunk = cols[5][start:end]
            i, j = int(cols[2][start]), int(cols[3][start])
            a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
            return [(prints[p], prints[q]) for p, q in _forest(prints, a, b, max_bits)]

        def emit(found):
            pairs = np.array(found, np.uint64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))], names=["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(cols[0]):
                continue
            held.append(cols)
            if all(c[0] == c[-1] == h[-1] for c, h in zip(cols[:4], held[0][:4], strict=True)):
                continue
            joined = [np.concatenate(x) for x in zip(*held, strict=True)]
            *done, last = groups(joined)
            found = [e for s, t in done for e in edges_of(joined, s, t)]
            if found:
                yield emit(found)
            held = [[c[last[0] : last[1]] for c in joined]]
        if held:
            joined = [np.concatenate(x) for x in zip(*held, strict=True)]
            if found := [e for s, t in groups(joined) for e in edges_of(joined, s, t)]:
                yield emit(found)

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """From distinct fingerprints (_fp): edges a, b that connect just what links of at most ``max_bits`` connect."""
    spark = prints.sparkSession
    parts = shuffle_partitions(spark)
    keyed = prints.select("_fp", _keys(max_bits).alias("x")).select("_fp", "x.t", "x.k")
    sizes = keyed.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(sizes.hint("merge"), ["t", "k"])
    chunks = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    mine = F.pmod(F.xxhash64("_fp"), chunks).cast("int")
    dealt = shared.select("t", "k", "_fp", mine.alias("c"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("o"))
    dealt = dealt.select("t", "k", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "_fp", "c")
    dealt = dealt.repartition(parts, "t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    return dealt.mapInArrow(tidy(_verify(max_bits)), "a long, b long").distinct()


def classes(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """From rows (doc_id, _fp): each distinct _fp with its component's _root (a fingerprint) and component_id (the smallest doc_id)."""
    groups = materialize(prints.groupBy("_fp").agg(F.min("doc_id").alias("_first")), "fingerprints")
    found = connected_components(links(groups.select("_fp"), max_bits), "a", "b")
    labelled = groups.join(found.withColumnRenamed("node", "_fp").hint("merge"), "_fp", "left").select("_fp", "_first", F.coalesce("component", "_fp").alias("_root"))
    lowest = labelled.groupBy("_root").agg(F.min("_first").alias("component_id"))
    return materialize(labelled.join(lowest.hint("merge"), "_root").select("_fp", "_root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id for every row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other.
    Repeated ids give a row each, by their own texts. Null ids are left out of
    the minimum (a component of nothing else has a null id). An empty table
    gives an empty result; extra columns are ignored.
    """
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = materialize(fingerprints(own, ["doc_id"]), "simhash")
    found = classes(prints, max_bits)
    return prints.join(found.hint("merge"), "_fp").select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row of its smallest id stays.

    Among repeated rows of that id, one stays (the lowest text hash). Rows
    without an id stay last: one of a component that has no id at all.
    """
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_th"))
    prints = materialize(fingerprints(own, ["doc_id", "_th"]), "simhash")
    found = classes(prints, max_bits)
    kept = prints.join(found.hint("merge"), "_fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    key = unused(docs.columns, "_d", "_n", "_t")
    kept = kept.groupBy("_root", "component_id").agg(F.min("_th").alias(key[2])).select(*_id_key(F.col("component_id"), key), key[2])
    keyed = docs.select("*", *_id_key(F.col(id_column).cast("long"), key), F.xxhash64(text).alias(key[2]))
    # The join and the choice among repeated rows share one exchange of the texts.
    return keyed.join(kept.hint("merge"), key, "left_semi").dropDuplicates(key).select(*docs.columns)


def _id_key(c: Column, names: list[str]) -> list[Column]:
    """An id as two columns that are never null, so that plain equality joins null ids too."""
    return [F.coalesce(c, F.lit(0)).alias(names[0]), c.isNull().alias(names[1])]
