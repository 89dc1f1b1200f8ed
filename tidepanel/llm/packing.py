"""Best-fit packing of token sequences, improved by swaps between underfull bins.

Lengths are whole numbers up to the capacity, so the packing problem is known
from a histogram of at most ``capacity`` counts, however many rows there are.
The plan is made on that histogram: a bin class is a pattern of lengths and
how many bins have it. Best fit in decreasing order of length fills classes;
then a local search over the underfull classes moves one piece, exchanges one
for one, or two for one, whenever that raises the sum of squared fills, until
nothing does; bins that empty on the way are gone. Partners are found by an
index of what underfull classes can give, so each class asks for its gap only.

Rows get their places by rank within their length: each task numbers its rows
of a length, counts of (task, length) are summed up to offsets, and a segment
of ranks maps to bins by arithmetic. No length, however common, meets in one
task, and only the plan (bounded by the capacity) is broadcast.

Null text counts as empty and still ends in the end token; a text of any length
is tokenized whole and cut into pieces; repeated rows are packed each. Rows of
one length are alike to the plan, and rows of a task are numbered as they come,
so ties take places in any order. An empty table gives an empty result; extra
columns of ``pack`` pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import slices, text_bytes
from .bpe import word_encoder
from .tables import materialize, unused

CAPACITY = 4096
END_ID = 1

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _tokenize(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path).text
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), text_bytes(part.column(1)), strict=True):
                    ids = encode(text) + end
                    for k, at in enumerate(range(0, len(ids), width)):
                        own = ids[at : at + width]
                        rows.append((doc, k, at // 4, len(own) // 4, zlib.crc32(own)))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Documents as token pieces of at most ``capacity``: doc_id, piece, start, length, ids_crc32."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text)).mapInArrow(_tokenize(path, capacity, end_id), _PIECES)


class Bins:
    """Bin classes by free space: patterns of lengths with how many bins have each."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_free: dict[int, dict[tuple[tuple[int, int], ...], int]] = {}
        self.frees: list[int] = []

    def add(self, pattern: tuple[tuple[int, int], ...], bins: int) -> None:
        """pattern: (length, copies) in decreasing order of length."""
        if bins <= 0 or not pattern:
            return
        free = self.capacity - sum(n * c for n, c in pattern)
        if free not in self.by_free:
            self.by_free[free] = {}
            insort(self.frees, free)
        own = self.by_free[free]
        own[pattern] = own.get(pattern, 0) + bins

    def take(self, free: int, pattern: tuple[tuple[int, int], ...], bins: int) -> None:
        own = self.by_free[free]
        own[pattern] -= bins
        if not own[pattern]:
            del own[pattern]
        if not own:
            del self.by_free[free]
            self.frees.pop(bisect_left(self.frees, free))

    def tightest(self, length: int) -> int | None:
        k = bisect_left(self.frees, length)
        return self.frees[k] if k < len(self.frees) else None

    def classes(self) -> list[tuple[tuple[tuple[int, int], ...], int]]:
        return [(p, n) for free in self.frees for p, n in sorted(self.by_free[free].items(), reverse=True)]


def best_fit(histogram: dict[int, int], capacity: int) -> Bins:
    bins = Bins(capacity)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            free = bins.tightest(length)
            if free is None:
                each = capacity // length
                bins.add(((length, each),), left // each)
                bins.add(((length, left % each),), int(left % each > 0))
                break
            pattern, many = next(iter(bins.by_free[free].items()))
            each = free // length
            if whole := min(many, left // each):
                bins.take(free, pattern, whole)
                bins.add((*pattern, (length, each)), whole)
                left -= whole * each
            else:
                bins.take(free, pattern, 1)
                bins.add((*pattern, (length, left)), 1)
                left = 0
    return bins


def _changed(pattern, out=(), into=()):
    counts = Counter(dict(pattern))
    counts.subtract(out)
    counts.update(into)
    return tuple(sorted(((n, c) for n, c in counts.items() if c), reverse=True))


class _Sources:
    """Underfull classes by the lengths (one piece or two) that they can give, and by value the most free space among them.

    Heaps hold classes that are gone until they come to the top.
    """

    def __init__(self, bins: Bins):
        self.bins = bins
        # Free space of the emptiest class that can give this much, by one piece and by two; -1 if none.
        self.most = [np.full(bins.capacity + 1, -1, np.int64) for _ in range(2)]
        self.heaps: list[dict[int, list]] = [{}, {}]
        self.held: list[set] = [set(), set()]

    def sums(self, pattern) -> tuple[dict[int, tuple[int, ...]], dict[int, tuple[int, ...]]]:
        """What one piece or two pieces of a pattern come to, up to the capacity."""
        two = {}
        for k, (a, copies) in enumerate(pattern):
            for b, _ in pattern[k + (copies < 2) :]:
                if a + b <= self.bins.capacity:
                    two[a + b] = (a, b)
        return {n: (n,) for n, _ in pattern}, two

    def add(self, free: int, pattern) -> None:
        for most, heaps, held, own in zip(self.most, self.heaps, self.held, self.sums(pattern), strict=True):
            for n in own:
                if (n, pattern) not in held:
                    held.add((n, pattern))
                    heappush(heaps.setdefault(n, []), (-free, pattern))
                most[n] = max(most[n], free)

    def gone(self, pattern) -> None:
        """To be called once a class has no bins."""
        for most, heaps, held, own in zip(self.most, self.heaps, self.held, self.sums(pattern), strict=True):
            for n in own:
                heap = heaps[n]
                while heap and heap[0][1] not in self.bins.by_free.get(-heap[0][0], ()):
                    held.discard((n, heappop(heap)[1]))
                most[n] = -heap[0][0] if heap else -1

    def exchange(self, full, free: int):
        """The exchange that fills ``full`` most: (source_free, source, out, into), or None.

        ``full`` gives nothing or one piece for one piece, two for one, or one
        for two, to a class with as much free space or more; any gain of the
        fuller bin then raises the sum of squared fills.
        """
        one, two = self.sums(full)
        best, found = 0, None
        for k, outs in ((0, {0: ()} | one), (0, two), (1, one)):
            most = self.most[k]
            for total, out in outs.items():
                # Only gains above the best so far.
                fit = np.flatnonzero(most[total + best + 1 : total + free + 1] >= free)
                if len(fit):
                    best += int(fit[-1]) + 1
                    found = k, total + best, out
                    if best == free:
                        break
            if best == free:
                break
        if found is None:
            return None
        k, into, out = found
        space, source = self.heaps[k][into][0]
        return -space, source, out, self.sums(source)[k][into]


def local_search(bins: Bins) -> Bins:
    """Move and exchange between underfull classes until nothing raises the sum of squared fills.

    Each exchange raises it, so the search ends; a round over all classes
    without an exchange shows that none is left.
    """
    sources = _Sources(bins)
    for free in bins.frees:
        for pattern in bins.by_free[free] if free else ():
            sources.add(free, pattern)

    def take(free, pattern, times):
        bins.take(free, pattern, times)
        if free and pattern not in bins.by_free.get(free, ()):
            sources.gone(pattern)

    def add(pattern, times):
        if pattern:
            free = bins.capacity - sum(n * c for n, c in pattern)
            new = pattern not in bins.by_free.get(free, ())
            bins.add(pattern, times)
            if new and free:
                sources.add(free, pattern)

    moved = True
    while moved:
        moved = False
        for free, full in [(free, p) for free in bins.frees if free for p in bins.by_free[free]]:
            while many := bins.by_free.get(free, {}).get(full, 0):
                # One bin of the class stands aside, so that it finds another bin.
                take(free, full, 1)
                found = sources.exchange(full, free)
                add(full, 1)
                if not found:
                    break
                source_free, source, out, into = found
                both = full == source
                times = many // 2 if both else min(many, bins.by_free[source_free][source])
                take(free, full, times * (1 + both))
                if not both:
                    take(source_free, source, times)
                add(_changed(full, out, into), times)
                add(_changed(source, into, out), times)
                moved = True
    return bins


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns and how many bins have each, for a histogram of lengths."""
    return local_search(best_fit(histogram, capacity)).classes()


def _segments(classes) -> dict[str, np.ndarray]:
    """For ranks of each length from ``first`` on: class size, first bin and offset."""
    rows, used, base = [], Counter(), 0
    for pattern, bins in classes:
        offset = 0
        for length, copies in pattern:
            rows.append((length, used[length], bins, base, offset))
            used[length] += bins * copies
            offset += length * copies
        base += bins
    rows.sort()
    cols = list(zip(*rows, strict=True)) if rows else [()] * 5
    return {k: np.array(c, np.int64) for k, c in zip(("length", "first", "bins", "base", "offset"), cols, strict=True)}


def _number(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Add the task and the row's number among this task's rows of its length."""
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            numbers = []
            for n in batch.column("length").to_pylist():
                numbers.append(seen[n])
                seen[n] += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(numbers), pa.int64()), pa.array(numbers, pa.int64())], names=[*batch.schema.names, *names])

    return run


def _place(sent, ranks: str, out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = sent.value
        edges = {n: (a, b) for n, a, b in zip(*(x.tolist() for x in (lambda u: (u[0], u[1], np.append(u[1][1:], len(seg["length"]))))(np.unique(seg["length"], return_index=True))), strict=True)}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column(ranks).to_numpy()
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                a, b = edges[int(n)]
                at[own] = a + np.searchsorted(seg["first"][a:b], rank[own], "right") - 1
            within = rank - seg["first"][at]
            kept = [c for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != ranks]
            names = [n for n in batch.schema.names if n != ranks]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(seg["base"][at] + within % seg["bins"][at]), pa.array(seg["offset"][at] + within // seg["bins"][at] * length)], names=[*names, *out])

    return run


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` from 1 to ``capacity``.

    Other columns pass through; where they have these names, the new ones are
    lengthened.
    """
    spark = rows.sparkSession
    task, number, rank, count, before, sequence, offset = unused(rows.columns, "_task", "_number", "_rank", "_n", "_before", "sequence_id", "offset")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    numbered = materialize(rows.mapInArrow(_number([task, number]), f"{fields}, `{task}` long, `{number}` long"), "pieces")
    counts = numbered.groupBy(task, "length").agg(F.count("*").alias(count))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum(count).alias("n")).collect()}
    segments = _segments(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(task, "length", F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias(before))
    ranked = numbered.join(offsets.hint("merge"), [task, "length"]).select(*(F.col(f"`{c}`") for c in rows.columns), (F.col(before) + F.col(number)).alias(rank))
    return ranked.mapInArrow(_place(spark.sparkContext.broadcast(segments), rank, [sequence, offset]), f"{fields}, `{sequence}` long, `{offset}` long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every document's pieces."""
    return pack(pieces(docs, path, capacity, end_id), capacity)
