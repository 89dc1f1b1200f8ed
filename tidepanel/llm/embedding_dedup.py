"""Embedding near-dedup by sorted projection passes.

Vectors of equal label (and length) are compared by cosine in double precision.

1. Vectors that are equal as they stand are one class with a count.
2. Each pass orders the classes of a label lexicographically by 32 concatenated
   random hashes (signs of random projections of the vectors less their label's
   mean) and compares each with the ``WINDOW`` before it by the raw cosine. The
   order is a distributed sort; heads and tails of neighbouring parts meet in a
   second, small step. Pairs that reach the threshold are links.
3. Each pass measures for each class how many leading hashes lead to a group
   that lies within its window. A class takes part until the passes leave a
   partner at the threshold unseen with probability ``MISS`` at most. Classes
   that passes don't get there are compared with each other exactly, chunk
   against chunk; of those links only spanning forests become rows.
4. The union of all links gives components (see ``components``).
5. Links are counted exactly inside each component, chunk against chunk, so
   what windows missed inside a group is counted too. Pairs are never rows.

At least as many passes are made as balanced hashes need for the largest label
(``passes_for``). What a pass is worth is measured, since hashes need not be
balanced: with spread a (squared distance to the mean), any partner at the
threshold t agrees in a hash with p = 1 - asin(sqrt((2 - 2t) / a)) / pi at
least, 0 if a is below 2 - 2t, and is seen if it agrees in the d leading hashes
whose group lies within the window; so a pass leaves it with 1 - p^d. Passes go
on while the rest is too large to compare (``EXACT_ROWS``), ``MOST_PASSES`` at
most; the rest is compared whatever its size, so dense labels cost their square.

Null labels, and vectors that are null, zero, or hold null or non-finite
components link with nothing: no links, their own component, kept. Repeated
rows are vectors of their own. A null id is no candidate for a component's
smallest. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .tables import drop, materialize, shuffle_partitions

THRESHOLD = 0.93
WINDOW = 24
MISS = 0.02
HASHES = 32
CHUNK = 1024
PASSES_AT_ONCE = 3
MOST_PASSES = 96
#: The rest is compared at once if its classes have so many others in their label on average.
EXACT_ROWS = 8192
#: Copies of each label's row, so that the rows of a common label join in many tasks.
SALTS = 32
#: Tables of a row a label are broadcast if the means hold no more bytes; else both sides are shuffled.
BROADCAST_BYTES = 32 << 20
SEED = 20


def passes_for(largest: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS) -> int:
    agree = 1 - math.acos(min(1.0, threshold)) / math.pi
    near = agree ** max(1.0, math.log2(max(2, largest) / window))
    return min(MOST_PASSES, max(4, math.ceil(math.log(miss) / math.log(1 - near))))


def usable(vector):
    """Whether a vector is there, finite in all components and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column, dtype) -> np.ndarray:
    """Binary vectors of equal length as rows of unit length."""
    x = np.frombuffer(b"".join(column), dtype).reshape(len(column), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _planes(size: int, first: int, count: int) -> np.ndarray:
    return np.concatenate([np.random.default_rng((SEED, size, p)).normal(size=(HASHES, size)) for p in range(first, first + count)])


def _pack_vectors(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v, dtype).tobytes() for v in batch.column("_v").to_pylist()]
            names = [n for n in batch.schema.names if n != "_v"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(vectors, pa.binary())], names=[*names, "v"])

    return run


def _sums(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the unit vectors of each label and size in each batch."""
        for batch in batches:
            of: dict[tuple[int, int], list[bytes]] = {}
            for label, size, v in zip(*(batch.column(n).to_pylist() for n in ("label", "size", "v")), strict=True):
                of.setdefault((label, size), []).append(v)
            sums = [_matrix(v, dtype).sum(0).tobytes() for v in of.values()]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in of], pa.int64()), pa.array([k[1] for k in of], pa.int32()), pa.array([len(v) for v in of.values()], pa.int64()), pa.array(sums, pa.binary())], names=["label", "size", "n", "s"])

    return run


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_sums`` come sorted by label and size."""
    key, n, total = None, 0, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int32()), pa.array([(total / n).tobytes()], pa.binary())], names=["label", "size", "mean"])

    for batch in batches:
        for label, size, more, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (label, size):
                if key:
                    yield done()
                key, n, total = (label, size), 0, 0.0
            n, total = n + more, total + np.frombuffer(s)
    if key:
        yield done()


def _keys(dtype: str, first: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each pass, with its sort key."""
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors, means = batch.column("v").to_pylist(), batch.column("mean").to_pylist()
            keys = np.zeros((len(vectors), count), np.int64)
            spread = np.zeros(len(vectors))
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                x = _matrix([vectors[i] for i in own], dtype)
                x -= np.frombuffer(b"".join(means[i] for i in own)).reshape(x.shape)
                spread[own] = (x * x).sum(1)
                if size not in planes:
                    planes[size] = _planes(x.shape[1], first, count)
                signs = x @ planes[size].T > 0
                weights = 1 << np.arange(HASHES - 1, -1, -1, dtype=np.int64)
                keys[own] = signs.reshape(len(own), count, HASHES) @ weights
            for p in range(count):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(vectors), first + p, np.int32)), batch.column("label"), batch.column("size"), pa.array(keys[:, p].copy()), batch.column("cid"), batch.column("v"), pa.array(spread)], names=_LINE)

    return run


def _gains(rows: list[tuple], window: int, threshold: float) -> np.ndarray:
    """For sorted rows of the line, the logarithm of the chance that this pass leaves a partner at the threshold unseen.

    It is 0 (no gain) where the rows don't show what lies a window further.
    """
    if not rows:
        return np.zeros(0)
    own = np.array([r[:4] for r in rows], np.int64)
    at = np.arange(len(rows))
    new = np.append(True, (own[1:, :3] != own[:-1, :3]).any(1))
    start = np.maximum.accumulate(np.where(new, at, 0))
    ends = np.append(np.flatnonzero(new)[1:], len(rows))
    end = ends[np.cumsum(new) - 1]
    depth, known = np.zeros(len(rows)), np.ones(len(rows), bool)
    for other, inside, shown in ((at - window - 1, at - window - 1 >= start, start > 0), (at + window + 1, at + window + 1 < end, end < len(rows))):
        unlike = own[:, 3] ^ own[np.clip(other, 0, len(rows) - 1), 3]
        common = HASHES - np.frexp(unlike.astype(np.float64))[1]
        known &= np.where(inside, common < HASHES, shown)
        depth = np.maximum(depth, np.where(inside, common + 1, 0))
    reach = (2 - 2 * threshold) / np.maximum(np.array([r[6] for r in rows]), 1e-300)
    agree = np.where(reach < 1, 1 - np.arcsin(np.sqrt(np.clip(reach, 0, 1))) / math.pi, 0.0)
    return np.where(known, np.log1p(-np.minimum(agree**depth, 1 - 1e-12)), 0.0)


def _near(rows: list[tuple], dtype: str, window: int, threshold: float, middle: int | None = None) -> list[tuple[int, int]]:
    """Linked ids among sorted rows of the line; across ``middle`` only, if that is given."""
    found = []
    at = 0
    while at < len(rows):
        end = at
        while end < len(rows) and rows[end][:3] == rows[at][:3]:
            end += 1
        if end - at > 1:
            x = _matrix([r[5] for r in rows[at:end]], dtype)
            for off in range(1, min(window, end - at - 1) + 1):
                for i in np.flatnonzero(np.einsum("ij,ij->i", x[:-off], x[off:]) >= threshold).tolist():
                    if middle is None or at + i < middle <= at + i + off:
                        found.append((rows[at + i][4], rows[at + i + off][4]))
        at = end
    return found


_LINE = ["p", "label", "size", "key", "cid", "v", "spread"]
_FOUND = pa.schema([("border", pa.int32()), ("side", pa.int32()), ("own", pa.bool_()), ("a", pa.int64()), ("b", pa.int64()), ("gain", pa.float64()), ("p", pa.int32()), ("label", pa.int64()), ("size", pa.int32()), ("key", pa.int64()), ("cid", pa.int64()), ("v", pa.binary()), ("spread", pa.float64())])


def _found(**columns) -> pa.RecordBatch:
    rows = max(map(len, columns.values()))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in _FOUND], schema=_FOUND)


def _compare(dtype: str, window: int, threshold: float):
    reach = window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links and gains of one sorted part, and its first and last rows for the borders, two windows each.

        Gains of the first and last ``reach`` rows are for the borders to tell (``own``).
        """
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def border(rows, number, side, own):
            return _found(border=[number] * len(rows), side=[side] * len(rows), own=own, **dict(zip(_LINE, zip(*rows, strict=True), strict=True)))

        tail: list[tuple] = []
        head: list[tuple] = []
        seen = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                rows = list(zip(*(c.to_pylist() for c in batch.slice(at, 4096).columns), strict=True))
                seen += len(rows)
                if len(head) < 2 * reach:
                    head += rows[: 2 * reach - len(head)]
                pairs = _near(rows, dtype, window, threshold)
                if tail:
                    pairs += _near(tail[-window:] + rows[:window], dtype, window, threshold, len(tail[-window:]))
                if pairs:
                    yield _found(a=[p[0] for p in pairs], b=[p[1] for p in pairs])
                both = tail + rows
                if len(both) > 2 * reach:
                    inner = slice(reach, len(both) - reach)
                    yield _found(cid=[r[4] for r in both[inner]], gain=_gains(both, window, threshold)[inner])
                tail = both[-2 * reach :]
        if head:
            yield border(head, part, 1, [k < reach for k in range(len(head))])
            yield border(tail, part + 1, 0, [k >= max(len(tail) - reach, reach - (seen - len(tail))) for k in range(len(tail))])

    return run


def _across(dtype: str, window: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by border and order; a few windows of rows a border."""
        held: list[tuple] = []

        def done():
            rows = [r[3:] for r in held]
            pairs = _near(rows, dtype, window, threshold, sum(r[1] == 0 for r in held))
            yield _found(a=[p[0] for p in pairs], b=[p[1] for p in pairs])
            own = [k for k, r in enumerate(held) if r[2]]
            yield _found(cid=[rows[k][4] for k in own], gain=_gains(rows, window, threshold)[own])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield from done()
                    held = []
                held.append(row)
        if held:
            yield from done()

    return run


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric matrix of links."""
    left, out = near.any(1), []
    for s in np.flatnonzero(left).tolist():
        if not left[s]:
            continue
        left[s] = False
        todo = [s]
        while todo:
            k = todo.pop()
            more = np.flatnonzero(near[k] & left)
            left[more] = False
            todo += more.tolist()
            out += [(k, x) for x in more.tolist()]
    return out


def _link_rest(dtype: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by label, size, i, j; a group is one chunk or a pair of chunks."""
        held: list[tuple] = []

        def done():
            x = _matrix([r[5] for r in held], dtype)
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            pairs = _forest(near)
            return pa.RecordBatch.from_arrays([pa.array([held[p[k]][4] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:4] != row[:4]:
                    yield done()
                    held = []
                held.append(row)
        if held:
            yield done()

    return run


def _join_labels(rows: DataFrame, table: DataFrame, per_label: list[str], few: bool) -> DataFrame:
    """Rows (with ``cid``) and what ``table`` says of their label; it is broadcast if there are few labels, else joined by salted keys."""
    if few:
        return rows.join(F.broadcast(table), per_label)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("cid"), F.lit(SALTS)).cast("int"))
    copies = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return salted.join(copies.hint("merge"), [*per_label, "salt"]).drop("salt")


def _deal(rows: DataFrame, by: list[str], parts: int) -> DataFrame:
    """Rows (with ``_n``, the rows of their group, and ``cid``) once for each pair i, j of chunks of their group, c the own one."""
    chunks = F.ceil(F.col("_n") / F.lit(CHUNK)).cast("int")
    mine = F.pmod(F.xxhash64("cid"), chunks).cast("int")
    dealt = rows.select("*", mine.alias("c"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("o"))
    dealt = dealt.withColumns({"i": F.least("c", "o"), "j": F.greatest("c", "o")})
    return dealt.repartition(parts, *by, "i", "j").sortWithinPartitions(*by, "i", "j")


def _count_links(dtype: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by component, i, j; a group is one chunk or a pair of chunks."""
        held: list[tuple] = []

        def done():
            i, j = held[0][1], held[0][2]
            x = _matrix([r[6] for r in held], dtype)
            copies = np.array([r[5] for r in held], np.int64)
            chunk = np.array([r[3] for r in held])
            cid = np.array([r[4] for r in held], np.int64)
            a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
            near = x[a] @ x[b].T >= threshold
            if i == j:
                np.fill_diagonal(near, False)
                return cid[a], near @ copies[b]
            return np.concatenate([cid[a], cid[b]]), np.concatenate([near @ copies[b], copies[a] @ near])

        def emit(found):
            return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1].astype(np.int64))], names=["cid", "n"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    yield emit(done())
                    held = []
                held.append(row)
        if held:
            yield emit(done())

    return run


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings``."""
    spark = embeddings.sparkSession
    parts = shuffle_partitions(spark)
    dtype = "<f4" if isinstance(embeddings.schema[vector].dataType.elementType, T.FloatType) else "<f8"
    own = embeddings.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("_v"))
    own = own.withColumn("_ok", F.col("label").isNotNull() & usable(F.col("_v")))
    packed = own.where("_ok").mapInArrow(_pack_vectors(dtype), "vec_id long, label long, _ok boolean, v binary").drop("_ok")
    grouped = packed.groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    classes = materialize(grouped.select("*", F.monotonically_increasing_id().alias("cid"), F.length("v").alias("size")), "vectors")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    sums = classes.select("label", "size", "v").mapInArrow(_sums(dtype), "label long, size int, n long, s binary")
    means = sums.repartition(parts, "label", "size").sortWithinPartitions("label", "size").mapInArrow(_means, "label long, size int, mean binary")
    means = materialize(means, "means")
    per_label = ["label", "size"]
    few = (means.agg(F.sum(F.length("mean") + 64)).first()[0] or 0) <= BROADCAST_BYTES

    found = []
    rest = classes.select("label", "size", "cid", "v", F.lit(0.0).alias("left"))
    line_schema = "p int, label long, size int, key long, cid long, v binary, spread double"
    found_schema = "border int, side int, own boolean, a long, b long, gain double, p int, label long, size int, key long, cid long, v binary, spread double"
    first, least = 0, passes_for(largest, threshold, window, miss)
    while largest and first < MOST_PASSES:
        count = min(PASSES_AT_ONCE, MOST_PASSES - first)
        keyed = _join_labels(rest, means, per_label, few).select("label", "size", "cid", "v", "mean").mapInArrow(_keys(dtype, first, count), line_schema)
        order = ["p", "label", "size", "key", "cid"]
        line = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        compared = materialize(line.mapInArrow(_compare(dtype, window, threshold), found_schema), "passes")
        borders = compared.where("border is not null").select("border", "side", "own", *_LINE)
        across = materialize(borders.repartition(parts, "border").sortWithinPartitions("border", "side", *order).mapInArrow(_across(dtype, window, threshold), found_schema), "borders")
        both = compared.where("border is null").union(across)
        found.append(materialize(both.where("a is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"))
        gains = both.where("gain < 0").groupBy("cid").agg(F.sum("gain").alias("gain"))
        after = rest.join(gains.hint("merge"), "cid", "left").select("label", "size", "cid", "v", (F.col("left") + F.coalesce("gain", F.lit(0.0))).alias("left"))
        after = materialize(after.where(F.col("left") > math.log(miss)), "rest")
        for done in (compared, across, rest):
            drop(done)
        rest = after
        first += count
        rows, pairs = rest.groupBy(*per_label).agg(F.count("*").alias("n")).agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n"))).first()
        if not rows or first >= least and pairs <= EXACT_ROWS * rows:
            break
    counted = rest.groupBy(*per_label).agg(F.count("*").alias("_n")).where("_n > 1")
    dealt = _deal(_join_labels(rest, counted, per_label, few).select("label", "size", "_n", "cid", "v"), per_label, parts).select("label", "size", "i", "j", "cid", "v")
    found.append(materialize(dealt.mapInArrow(_link_rest(dtype, threshold), "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"))
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    groups = materialize(connected_components(links, "a", "b"), "vector-components")

    members = classes.join(groups.hint("merge"), groups["node"] == classes["cid"]).select("component", "cid", "copies", "first", "v")
    sizes = groups.groupBy("component").agg(F.count("*").alias("_n"))
    lowest = members.groupBy("component").agg(F.min("first").alias("low"))
    dealt = _deal(members.join(sizes.hint("merge"), "component"), ["component"], parts).select("component", "i", "j", "c", "cid", "copies", "v")
    counts = dealt.mapInArrow(_count_links(dtype, threshold), "cid long, n long").groupBy("cid").agg(F.sum("n").alias("n"))

    placed = groups.join(lowest.hint("merge"), "component").select(F.col("node").alias("cid"), "low")
    joined = classes.join(counts.hint("merge"), "cid", "left").join(placed.hint("merge"), "cid", "left")
    known = materialize(joined.select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("low", "first").alias("component_id")), "vector-classes")
    linked = packed.join(known.hint("merge"), ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = own.where(~F.col("_ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
