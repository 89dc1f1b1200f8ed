import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import exact_dedup

RNG = random.Random(13)
TEXTS = ["", None, "a", "a ", "A", "x" * 40, "x" * 39 + "y", "ж" * 30, "same head of sixteen bytes one", "same head of sixteen bytes two", "long " * 60_000]


def rows():
    out = [(k, RNG.choice(TEXTS[:-1])) for k in range(300)]
    out += [(1000 + k, "hot " * 20) for k in range(400)] + [(5000, TEXTS[-1]), (5001, TEXTS[-1]), (5002, TEXTS[-1] + "!")]
    out += [(7, "a"), (7, "a"), (None, "a"), (None, "only without an id"), (None, "only without an id")]
    RNG.shuffle(out)
    return out


def frame(spark, data):
    return spark.createDataFrame([(i, t, "p", n, "q") for n, (i, t) in enumerate(data)], "doc_id long, text string, _text string, _n int, `a.b` string")


def expected(data, largest):
    groups = {}
    for i, t in data:
        groups.setdefault(t or "", []).append(i)
    pick = max if largest else min
    best = {t: pick([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    out = [(i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in data]
    return sorted(out, key=repr), {t: b for t, b in best.items()}


@pytest.mark.parametrize("largest", [True, False])
def test_groups_by_plain_grouping(spark, largest):
    data = rows()
    got = exact_dedup.exact_duplicates(frame(spark, data).repartition(5), largest=largest).collect()
    want, best = expected(data, largest)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(best)
    assert {r.text_sha256: r.doc_id for r in kept} == {hashlib.sha256(t.encode()).hexdigest(): b for t, b in best.items()}


def test_one_text_over_many_partitions(spark, monkeypatch):
    """A text that all rows share is dealt out, and its runs are put together again."""
    monkeypatch.setattr(exact_dedup, "PART_ROWS", 50)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 9, "everywhere").otherwise(F.lit(None)).alias("text"))
    got = exact_dedup.exact_duplicates(docs, largest=True)
    assert {(r.keep_id, r.group_size, r.n, r.k) for r in got.groupBy("keep_id", "group_size").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).collect()} == {(998, 900, 900, 1), (999, 100, 100, 1)}


def test_hash_collisions_are_told_apart(spark, monkeypatch):
    """With one hash for all texts the full comparison still decides, across partitions too."""
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    monkeypatch.setattr(exact_dedup, "PART_ROWS", 40)
    data = [(k, "same head of sixteen bytes " + "abc"[k % 3]) for k in range(300)]
    got = exact_dedup.exact_duplicates(frame(spark, data)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == [(k, k % 3, 100) for k in range(300)]
    assert sorted(r.doc_id for r in got if r.kept) == [0, 1, 2]


def test_keep_one_keeps_rows_as_they_are(spark):
    data = rows()
    docs = frame(spark, data)
    kept = exact_dedup.keep_one(docs.repartition(6))
    assert kept.schema.names == docs.schema.names and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
    out = kept.collect()
    _, best = expected(data, False)
    assert len(out) == len(best) and {(r.text or ""): r.doc_id for r in out} == best
    assert all(data[r._n] == (r.doc_id, r.text) for r in out)


def test_normalised_texts(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a  B"), (3, "c")], "doc_id long, text string")
    got = exact_dedup.exact_duplicates(docs, normalise=lambda t: F.lower(F.regexp_replace(t, " +", " "))).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (3, 3, True)}
    assert {r.text_sha256 for r in got if r.doc_id < 3} == {hashlib.sha256(b"a b").hexdigest()}


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_duplicates(none).collect() == [] and exact_dedup.keep_one(none).collect() == []
