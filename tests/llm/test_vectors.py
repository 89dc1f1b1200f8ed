import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import functions as F

from tidepanel.llm import embedding_dedup, topk

SCHEMA = "vec_id long, embedding array<float>, label int, key string"


def vectors(seed=2, n=150):
    rng = np.random.default_rng(seed)
    rows = [(k, rng.normal(size=16).astype(np.float32).tolist(), int(rng.integers(0, 3))) for k in range(n)]
    hub = rng.normal(size=16)
    rows += [(1000 + k, (hub + rng.normal(size=16) * 0.12).astype(np.float32).tolist(), 1) for k in range(90)]
    rows += [(2000 + k, rows[3][1], rows[3][2]) for k in range(5)] + [(2100, [2 * x for x in rows[3][1]], rows[3][2]), (2101, rows[3][1], rows[3][2] + 1)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1), (3003, [None] + [1.0] * 15, 1), (3004, [float("inf")] + [1.0] * 15, 1), (3005, rows[3][1], None), (3006, [1.0, 2.0], 1), (3, rows[3][1], rows[3][2])]
    return [(*r, "x") for r in rows]


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def test_links_and_components(spark):
    rows = vectors()
    got = [tuple(r) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    ok = [k for k, r in enumerate(rows) if usable(r[1]) and r[2] is not None]
    links = {k: set() for k in range(len(rows))}
    for i in ok:
        for j in ok:
            if i != j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.array(rows[k][1], np.float64) for k in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                    links[i].add(j)
    want = []
    for k, r in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        low = min(rows[x][0] for x in seen)
        want.append((r[0], len(links[k]), low, low == r[0]))
    assert sum(w[1] for w in want) > 5000
    assert sorted(got) == sorted(want)


def test_small_chunks_count_the_same(spark, monkeypatch):
    rows = spark.createDataFrame(vectors(), SCHEMA)
    before = sorted(tuple(r) for r in embedding_dedup.near_duplicates(rows).collect())
    monkeypatch.setattr(embedding_dedup, "CHUNK", 16)
    assert sorted(tuple(r) for r in embedding_dedup.near_duplicates(rows).collect()) == before


def test_many_labels_join_by_salted_keys(spark, monkeypatch):
    rows = spark.createDataFrame(vectors(), SCHEMA)
    before = sorted(tuple(r) for r in embedding_dedup.near_duplicates(rows).collect())
    monkeypatch.setattr(embedding_dedup, "BROADCAST_BYTES", -1)
    assert sorted(tuple(r) for r in embedding_dedup.near_duplicates(rows).collect()) == before


def test_passes_grow_with_the_largest_label():
    assert embedding_dedup.passes_for(10) <= embedding_dedup.passes_for(5000) < embedding_dedup.passes_for(10_000_000) <= 96


def brute_top(rows, k, wanted):
    ok = [(r[0], [int(np.floor(256 * np.float64(np.float32(x)))) for x in r[1]]) for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    out = []
    for i, (q, v) in enumerate(ok):
        if wanted(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for j, (c, w) in enumerate(ok) if j != i and len(w) == len(v))
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:k], 1)]
    return out


def test_top_k(spark, monkeypatch):
    rows = vectors()
    want = sorted(brute_top(rows, 5, lambda q: q % 50 == 0))
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()) == want
    monkeypatch.setattr(topk, "CANDIDATES", 40)
    assert sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()) == want


def test_threshold_stops_early_and_stays_exact():
    rng = np.random.default_rng(0)
    x = np.floor(256 * rng.normal(size=(4000, 3)))
    lists = topk.Lists(x, np.arange(4000), np.arange(4000))
    best, scores, depth = lists.top(x[0], 0, 5, step=32)
    order = np.lexsort((np.arange(4000), -(x @ x[0])))
    assert best.tolist() == [i for i in order.tolist() if i][:5] and depth < 2000


def test_an_opening_score_shortens_the_walk():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.normal(size=(4000, 3)))
    lists = topk.Lists(x, np.arange(4000), np.arange(4000))
    best, scores, depth = lists.top(x[0], 0, 5, step=32)
    again, same, shallow = lists.top(x[0], 0, 5, scores.min(), step=32)
    assert again.tolist() == best.tolist() and same.tolist() == scores.tolist() and shallow <= depth
    assert lists.top(x[0], 0, 5, scores.max() + 1, step=32)[2] <= shallow
    assert lists.best(x[0], 0, 5, int(scores.max()) + 1)[1] == []


def test_values_of_any_size(spark, monkeypatch):
    """Scores far beyond what doubles and longs hold: exact ranks, and the nearest long as the score."""
    rng = np.random.default_rng(9)
    sizes = [1.0, 3e7, 2e12, 1e17, 3e38, 1e300]
    rows = [(k, [float(x) for x in rng.normal(size=4) * 10.0 ** rng.uniform(0, np.log10(sizes[k % 6]))]) for k in range(120)]
    rows += [(k, [1.7e308, -1.7e308, 1e-300, -1e-300]) for k in (201, 200)] + [(250, [1e308, 1e308, 0.5, -0.5]), (300, [1e20] * 4), (301, [1e25] * 4), (350, [1e30] * 4)]
    scaled = [(k, [math.floor(256 * Fraction(x)) for x in v]) for k, v in rows]
    want = []
    for q, v in scaled:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in scaled if c != q)[:5]
            want += [(q, rank, c, max(-(1 << 63), min(-s, (1 << 63) - 1))) for rank, (s, c) in enumerate(best, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for size, group in ((8192, 1 << 25), (30, 1 << 25), (10, 700)):
        monkeypatch.setattr(topk, "CANDIDATES", size)
        monkeypatch.setattr(topk, "GROUP_BYTES", group)
        assert sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 50 == 0).collect()) == sorted(want)


def test_keys_sort_like_numbers():
    numbers = [0, 1, -1, 255, 256, -255, -256, 1 << 124, -(1 << 124), (1 << 2100) + 1, 1 << 2100, -(1 << 2100), -(1 << 2100) - 1]
    assert sorted(numbers) == sorted(numbers, key=topk.sortable) and [topk.from_sortable(topk.sortable(n)) for n in numbers] == numbers


def test_a_query_is_sent_once_to_each_group(spark, monkeypatch):
    """15 blocks of about 20 rows in groups of three: five rows for each query, wherever it is asked."""

    def seen(k):
        def run(batches):
            for b in batches:
                ids = b.filter(pc.equal(b.column("kind"), 1)).column("vec_id")
                n = len(ids)
                yield pa.RecordBatch.from_arrays([ids, ids, pa.nulls(n, pa.int64()), pa.array([b""] * n, pa.binary()), pa.array([0] * n)], names=["query_row", "query_id", "vec_id", "key", "score"])

        return run

    monkeypatch.setattr(topk, "CANDIDATES", 20)
    monkeypatch.setattr(topk, "GROUP_BYTES", 20 * 4 * 8 * 3)
    monkeypatch.setattr(topk, "_search", seen)
    monkeypatch.setattr(topk, "shuffle_partitions", lambda spark: 2)
    frame = spark.createDataFrame([(k, [float(k % 7), 1.0, -float(k % 5), 0.5]) for k in range(300)], "vec_id long, embedding array<double>")
    got = topk.top_k(frame, F.col("vec_id") % 50 == 0, 100).groupBy("query_id").count().collect()
    assert {r["query_id"]: r["count"] for r in got} == {k: 5 for k in range(0, 300, 50)}


def test_ties_and_few_rows(spark):
    rows = [(k, [1.0, 0.0], 0, "x") for k in (50, 3, 2, 1)] + [(0, [0.0, 0.0], 0, "x")]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, 3).collect())
    assert got == [(0, 1, 1, 0), (0, 2, 2, 0), (0, 3, 3, 0), (50, 1, 1, 65536), (50, 2, 2, 65536), (50, 3, 3, 65536)]


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert embedding_dedup.near_duplicates(empty).count() == 0
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


def with_pairs(typical, n, pairs, seed=7, size=64):
    """Unit vectors of one label with a typical cosine, the last ``pairs`` with a partner at cosine 0.935 among the first."""
    rng = np.random.default_rng(seed)
    mean = rng.normal(size=size)
    mean *= np.sqrt(typical) / np.sqrt(mean @ mean)
    x = rng.normal(size=(n, size)) * np.sqrt((1 - typical) / size) + mean
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    y = rng.normal(size=(pairs, size))
    y -= (y * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    y /= np.sqrt((y * y).sum(1, keepdims=True))
    return np.concatenate([x, 0.935 * x[:pairs] + np.sqrt(1 - 0.935**2) * y]).astype(np.float32)


def missed(spark, x, **parameters):
    frame = spark.createDataFrame([(k, v.tolist(), 1, "x") for k, v in enumerate(x)], SCHEMA)
    y = x.astype(np.float64)
    y /= np.sqrt((y * y).sum(1, keepdims=True))
    want = (y @ y.T >= 0.93).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(frame, **parameters).collect()}
    assert all(got[k] <= w for k, w in enumerate(want.tolist()))
    return int(want.sum()) - sum(got.values()), int(want.sum())


def test_links_among_vectors_with_a_common_mean(spark):
    lost, links = missed(spark, with_pairs(0.8, 3000, 200))
    assert links >= 400 and lost == 0


def test_gains_tell_what_a_pass_sees():
    # Two windows of one key between other keys: only the middle knows that its group is too wide.
    keys = [0] * 3 + [1 << 30] * 9 + [1 << 31] * 3
    gains = embedding_dedup._gains([(0, 0, 8, key, k, b"", 1.0) for k, key in enumerate(keys)], 2, 0.93)
    assert (gains[:3] == 0).all() and (gains[-3:] == 0).all() and (gains[3:12] == 0).all()
    keys = [k << 28 for k in range(16)]
    gains = embedding_dedup._gains([(0, 0, 8, key, k, b"", 1.0) for k, key in enumerate(keys)], 2, 0.93)
    assert (gains[:3] == 0).all() and (gains[3:-3] < 0).all() and (gains[-3:] == 0).all()
