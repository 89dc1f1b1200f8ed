"""Exact top-k search by inner product, with Fagin's threshold algorithm.

Components are whole numbers, floor(256 x). Candidates lie in blocks of
bounded size; a block keeps one sorted list of its rows for each dimension,
made once for all queries. A query walks all lists of a block from their good
ends together (from the top where its component is positive, from the bottom
where it is negative), scores each row when a list first shows it, and stops as
soon as the bound - the score of an imagined row with the values at the lists'
present depth - is below its k-th best so far: no row not seen can beat or tie
it.

Blocks travel in groups of bounded size. A query first visits one group, its own
by hash, and then every other one, once each; within a group its k-th score so
far shortens the walk through the next block, and the k-th score of its own group
opens the walk through the others. So lists are left as soon as their bound falls
below it, and only rows that reach it are returned. A window over those, ordered
by score and then id, gives the result.

Candidates are sent once for each of the two visits and never copied; queries
are sent to every group, for each of them must be asked. The work is queries
times rows at worst; memory is one group and one query.

Vectors that are null or hold null or non-finite components take no part;
vectors of different lengths don't meet. Scores are exact and ranked exactly for
values of any size: where doubles would round, the same walk is made in whole
numbers of any length, and scores travel as bytes that sort like numbers. A score
that a long does not hold is returned as the nearest long. Repeated rows are
candidates of their own, also for their copies. Ties go to the smaller id (null
last). Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialize, shuffle_partitions

SCALE = 256
K = 5
CANDIDATES = 8192
#: Bytes of vectors in a group of blocks.
GROUP_BYTES = 32 << 20
STEP = 256
#: Whole numbers below this stay exact as doubles.
EXACT = 1 << 53
#: Components travel as doubles, less by this power of two, so that none overflows. That is exact.
_SHIFT = 16
_MOST = (1 << 63) - 1


def _shifted(v: list[float]) -> np.ndarray:
    """floor(SCALE x) / 2^_SHIFT; beyond 2^60 a double is a whole number anyway."""
    x = np.asarray(v, np.float64)
    large = np.abs(x) >= 2.0**60
    return np.where(large, x * (SCALE / 2.0**_SHIFT), np.floor(SCALE * np.where(large, 0, x)) / 2.0**_SHIFT)


def _whole(z: float) -> int:
    n, d = z.as_integer_ratio()
    return (n << _SHIFT) // d


def _scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [n for n in batch.schema.names if n != "_v"]
        vectors = [_shifted(v).tobytes() for v in batch.column("_v").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(vectors, pa.binary())], names=[*names, "v"])


def sortable(n: int) -> bytes:
    """Bytes that sort like the number: sign and length, then the size, turned over for negative numbers."""
    size = abs(n).to_bytes((abs(n).bit_length() + 7) // 8)
    head = (1 << 15) + len(size) if n >= 0 else (1 << 15) - 1 - len(size)
    return head.to_bytes(2) + (size if n >= 0 else bytes(255 - b for b in size))


def from_sortable(key: bytes) -> int:
    positive = key[0] >= 128
    return int.from_bytes(key[2:]) if positive else -int.from_bytes(bytes(255 - b for b in key[2:]))


def _best_first(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """By score, then by id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i])), np.int64)
    return np.lexsort((ids, -scores))


class Lists:
    """A block of candidates with a sorted list for each dimension; ``x`` is less by 2^_SHIFT if ``shifted``."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, shifted: bool = False):
        self.ids, self.rows = ids, rows
        self.order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
        self.shifted = x if shifted else x / 2.0**_SHIFT
        self.largest = _whole(float(np.abs(self.shifted).max())) if x.size else 0
        self.plain = self.shifted * 2.0**_SHIFT if self.largest < EXACT else None
        self.whole: np.ndarray | None = None

    def best(self, q: np.ndarray, row: int, k: int, least: int | None = None, shifted: bool = False) -> tuple[np.ndarray, list[int]]:
        """Positions and exact scores of the block's k best rows, of which each scores ``least`` at least."""
        z = q if shifted else q / 2.0**_SHIFT
        if len(z) * self.largest * _whole(float(np.abs(z).max())) < EXACT and self.plain is not None:
            values, q = self.plain, z * 2.0**_SHIFT
        else:
            if self.whole is None:
                self.whole = np.array([[_whole(v) for v in x] for x in self.shifted.tolist()], object)
            values, q = self.whole, np.array([_whole(v) for v in z.tolist()], object)
        best, scores, _ = self._walk(values, q, row, k, least, STEP)
        found = [int(s) for s in scores.tolist()]
        n = len(found) if least is None else sum(s >= least for s in found)
        return best[:n], found[:n]

    def top(self, q: np.ndarray, row: int, k: int, least: float | None = None, step: int = STEP) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and scores of the k best rows, best first, and how deep the lists were read; in doubles."""
        return self._walk(self.plain, q, row, k, least, step)

    def _walk(self, values: np.ndarray, q: np.ndarray, row: int, k: int, least, step: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows below ``least`` need not be found. Doubles or whole numbers, as ``values`` and ``q`` are."""
        n = len(values)
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        seen = np.zeros(n, bool)
        best, scores = np.zeros(0, np.int64), np.zeros(0, values.dtype)
        depth = 0
        while depth < n:
            end = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.order[n - end : n - depth][:, up].ravel()] = True
            fresh[self.order[depth:end][:, down].ravel()] = True
            if not len(up) and not len(down):
                fresh[:] = True
                end = n
            new = np.flatnonzero(fresh & ~seen)
            seen[new] = True
            new = new[self.rows[new] != row]
            best, scores = np.concatenate([best, new]), np.concatenate([scores, values[new] @ q])
            if len(best) > k:
                # k best by score, then by id; what ties with the k-th goes by id.
                keep = _best_first(scores, self.ids[best])[:k]
                best, scores = best[keep], scores[keep]
            depth = end
            if depth < n:
                bound = values[self.order[n - depth, up], up] @ q[up] + values[self.order[depth - 1, down], down] @ q[down]
                if (least is not None and least > bound) or (len(best) == k and scores.min() > bound):
                    break
        keep = _best_first(scores, self.ids[best])
        return best[keep], scores[keep], depth


_FOUND = "query_row long, query_id long, vec_id long, key binary, score long"
_NO_ID = np.iinfo(np.int64).max


def _search(k: int):
    out_schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("key", pa.binary()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by size, group, kind, block: a group's candidates, block by block, before its queries."""
        key, held, lists = None, [], None
        out: list[tuple] = []

        def emit():
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), out_schema, strict=True)], schema=out_schema)
            out.clear()
            return batch

        for batch in batches:
            for size, group, kind, block, row, vec, v, least in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (size, group) != key:
                    key, held, lists = (size, group), [], None
                if kind == 0:
                    held.append((block, row, _NO_ID if vec is None else vec, v))
                    continue
                if lists is None:
                    lists = []
                    for _, own in groupby(held, itemgetter(0)):
                        _, rows, ids, vectors = zip(*own, strict=True)
                        lists.append(Lists(np.frombuffer(b"".join(vectors), np.float64).reshape(len(rows), -1), np.array(ids, np.int64), np.array(rows, np.int64), True))
                    held = []
                best: list[tuple[int, int, int]] = []  # score turned over, id, row
                lowest = None if least is None else from_sortable(least)
                q = np.frombuffer(v, np.float64)
                for x in lists:
                    at, scores = x.best(q, row, k, lowest, True)
                    best = sorted([*best, *((-s, int(x.ids[i]), int(x.rows[i])) for i, s in zip(at.tolist(), scores, strict=True))])[:k]
                    if len(best) == k:
                        lowest = -best[-1][0] if lowest is None else max(lowest, -best[-1][0])
                out += [(row, vec, None if i == _NO_ID else i, sortable(-s), max(-_MOST - 1, min(-s, _MOST))) for s, i, _ in best]
                if len(out) >= 20_000:
                    yield emit()
        if out:
            yield emit()

    return run


def top_k(embeddings: DataFrame, is_query, k: int = K, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best other rows of each row for which ``is_query`` holds.

    ``is_query`` is a column over ``vec_id``.
    """
    spark = embeddings.sparkSession
    parts = shuffle_partitions(spark)
    v = F.col("_v")
    finite = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    own = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v")).where(finite & (F.size(v) > 0))
    own = own.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.coalesce(is_query, F.lit(False)).alias("is_query"), "_v")
    table = materialize(own.mapInArrow(_scaled, "row long, vec_id long, is_query boolean, v binary"), "scaled")
    count, widest = table.agg(F.count("*"), F.max(F.length("v"))).first()
    blocks = max(1, math.ceil(count / CANDIDATES))
    # As many groups as tasks where blocks are few, and none beyond its bound where they are many.
    together = max(1, min(GROUP_BYTES // (CANDIDATES * (widest or 1)), blocks // parts))
    groups = math.ceil(blocks / together)
    own_block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    nothing = F.lit(None).cast("binary")
    placed = table.select(F.length("v").alias("size"), own_block.alias("block"), "row", "vec_id", "v", "is_query").withColumn("group", F.floor(F.col("block") / together).cast("int"))
    columns = ["size", "group", "kind", "block", "row", "vec_id", "v", "least"]
    candidates = placed.withColumns({"kind": F.lit(0), "least": nothing}).select(*columns)
    queries = placed.where("is_query").withColumn("kind", F.lit(1))

    def search(asked: DataFrame) -> DataFrame:
        met = candidates.unionByName(asked).repartition(max(parts, groups), "size", "group").sortWithinPartitions("size", "group", "kind", "block", "row")
        return met.mapInArrow(_search(k), _FOUND)

    first = materialize(search(queries.withColumn("least", nothing).select(*columns)), "first-group")
    # A group with fewer than k rows opens nothing.
    opening = first.groupBy(F.col("query_row").alias("row")).agg(F.count("*").alias("n"), F.min("key").alias("least")).where(F.col("n") >= k)
    asked = queries.join(opening.select("row", "least").hint("merge"), "row", "left")
    others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: g != F.col("own")))
    asked = asked.withColumnRenamed("group", "own").select("*", others.alias("group")).select(*columns)
    found = first.unionByName(search(asked))
    best = Window.partitionBy("query_row").orderBy(F.desc("key"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
