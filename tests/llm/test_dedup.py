import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidepanel.llm import components, simhash, substring_dedup
from tidepanel.llm.components import connected_components
from tidepanel.llm.tables import settings

RNG = random.Random(4)
VOCABULARY = [f"w{k}" for k in range(400)]
PASSAGE = " ".join(RNG.choices(VOCABULARY, k=60))


def text(n):
    return " ".join(RNG.choices(VOCABULARY, k=n))


def corpus():
    docs = [(k, text(RNG.randint(1, 120))) for k in range(60)]
    long = text(900)
    docs += [(100, long), (101, long), (102, long + " more"), (103, long.replace("w7 ", "w8 ", 1)), (104, long.upper())]
    docs += [(200, text(30) + " " + PASSAGE + " " + text(9)), (201, PASSAGE), (150, text(20) + "\n" + PASSAGE.replace(" ", "\t"))]
    docs += [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "one two"), (305, "a b c " * 700), (303, "one"), (None, PASSAGE), (None, PASSAGE), (306, "É é ünï " * 6)]
    docs += [(400 + k, long) for k in range(40)]
    RNG.shuffle(docs)
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id long, text string, component_id string, _fp long")


def plain_fingerprint(t):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def lowest_reachable(prints, ids):
    """Components by brute force over fingerprints; the smallest id of each row's."""
    n = len(prints)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    low = {}
    for k, i in enumerate(ids):
        r = find(k)
        low[r] = i if low.get(r) is None else low[r] if i is None else min(low[r], i)
    return [low[find(k)] for k in range(n)]


def test_fingerprint_of_many_shingles():
    for n in (0, 1, 2, 3, 4, 254, 255, 256, 257, 258, 700):
        t = text(n)
        assert simhash.fingerprint(t.encode()) == plain_fingerprint(t)


def test_simhash_components(spark):
    docs = corpus()
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(frame(spark, docs)).collect()), key=str)
    prints = [plain_fingerprint(t) for _, t in docs]
    want = sorted(((i, f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, lowest_reachable(prints, [i for i, _ in docs]), strict=True)), key=str)
    assert got == want


@pytest.mark.parametrize("chunk", [4, 64])
def test_links_connect_what_brute_force_connects(spark, chunk):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 12, dtype=np.int64)
    prints = {int(b) ^ (1 << int(x)) ^ (1 << int(y)) for b in base for x, y in rng.integers(0, 62, (40, 2))} | {0, -1, -2}
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "_fp long"), chunk=chunk)
    got = {r["node"]: r["component"] for r in connected_components(edges, "a", "b").collect()}
    every = sorted(prints)
    unsigned = [p & (1 << 64) - 1 for p in every]
    want = lowest_reachable(unsigned, every)
    assert [got.get(p, p) for p in every] == want


def test_keep_one(spark):
    docs = corpus()
    kept = simhash.keep_one(frame(spark, docs)).collect()
    prints = [plain_fingerprint(t) for _, t in docs]
    low = lowest_reachable(prints, [i for i, _ in docs])
    # One row of each component, that of its lowest id.
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted(set(low), key=str)
    assert kept[0].asDict().keys() == {"doc_id", "text", "component_id", "_fp"}


def test_rows_without_ids_keep_one_a_group(spark):
    docs = [(None, "a b c d e"), (None, "a b c d e"), (None, text(50)), (None, text(50)), (0, text(50)), (None, None)]
    kept = simhash.keep_one(frame(spark, docs)).collect()
    assert sorted((r["text"] for r in kept), key=str) == sorted({t for _, t in docs}, key=str)


def test_empty_tables(spark):
    empty = frame(spark, corpus()).limit(0)
    for f in (simhash.near_duplicates, simhash.keep_one, substring_dedup.removals, substring_dedup.remove):
        assert f(empty).count() == 0


def plain_removals(docs, window=13):
    words = [re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode()) for _, t in docs]
    low = {}
    key = lambda i: (i is None, i or 0)
    for (i, _), w in zip(docs, words, strict=True):
        for k in range(len(w) - window + 1):
            s = tuple(w[k : k + window])
            low[s] = min(low.get(s, key(i)), key(i))
    out = []
    for (i, _), w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if low[tuple(w[k : k + window])] < key(i):
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_removals(spark):
    docs = corpus()
    got = sorted((tuple(r) for r in substring_dedup.removals(frame(spark, docs)).collect()), key=str)
    assert got == sorted(plain_removals(docs), key=str)
    assert sum(r[2] for r in got) > 900


def test_removals_over_small_blocks_and_buckets(spark, monkeypatch):
    docs = corpus()
    want = sorted(plain_removals(docs, 5), key=str)
    for bucket, part, block in ((200, 48 << 20, 3 << 20), (100, 1500, 3 << 20), (1000, 300, 2000)):
        monkeypatch.setattr(substring_dedup, "BUCKET_TEXT", bucket)
        monkeypatch.setattr(substring_dedup, "PART_TEXT", part)
        monkeypatch.setattr(substring_dedup, "BLOCK_TEXT", block)
        assert sorted((tuple(r) for r in substring_dedup.removals(frame(spark, docs).repartition(9), window=5).collect()), key=str) == want


def test_buckets_survive_their_encoding():
    rng = np.random.default_rng(6)
    for n, spread in ((1, 1), (5, 1 << 63), (300, 40)):
        hashes = np.sort(rng.integers(0, spread, n, dtype=np.uint64))
        docs = rng.integers(-(1 << 62), 1 << 62, n)
        docs[0] = np.iinfo(np.int64).max
        h, d, at = substring_dedup._decoded(b"xx" + (payload := substring_dedup._encoded(hashes, docs)), n, 2)
        assert (h == hashes).all() and (d == docs).all() and at == 2 + len(payload)


def test_one_row_for_each_block_and_partition(spark):
    """However many buckets a partition has."""
    docs = frame(spark, corpus()).selectExpr("doc_id as _doc", "text as _text").coalesce(2)
    for each in (1, 7):
        sent = docs.mapInArrow(substring_dedup._send("_text", "_doc", 5, 8, each), "part int, block long, check long, n long, payload binary")
        rows = [(r["block"], r["part"]) for r in sent.collect()]
        assert len(rows) == len(set(rows)) <= 16


def test_remove_keeps_rows_and_columns(spark):
    docs = corpus()
    source = frame(spark, docs).withColumnRenamed("_fp", "n_chars")
    got = substring_dedup.remove(source)
    assert got.columns == source.columns and got.count() == len(docs)
    row = got.where("doc_id = 201").collect()[0]
    assert row["text"] == "" and row["component_id"] == "x"
    assert got.where("doc_id = 300").collect()[0]["text"] is None


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(5, 5), (None, 3), (1, 2), (2, 1), (1, 2)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = dict.fromkeys(range(100, 161), 100) | dict.fromkeys([7, *range(200, 260)], 7) | {1: 1, 2: 1}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_a_hub_is_dealt_to_many_tasks(spark):
    """Of a hub's 20,000 arcs no partition of the join has more than a few parts of SPREAD."""
    star = spark.range(1, 20_001).selectExpr("0L as u", "id as v").union(spark.range(1, 20_001).selectExpr("id as u", "0L as v"))
    with settings(spark, spark__sql__shuffle__partitions="32", spark__sql__adaptive__enabled="false"):
        placed = components._with_lowest(star)
        sizes = [r["n"] for r in placed.where("u = 0").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 20_000 / 5
        assert placed.where("m <> 0").count() == 0


def test_components_against_union_find(spark):
    rng = random.Random(12)
    edges = [(0, k) for k in range(1, 300)] + [(rng.randrange(300, 900), rng.randrange(300, 900)) for _ in range(420)] + [(k, k + 1) for k in range(900, 1000)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
