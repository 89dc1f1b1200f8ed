import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidepanel.llm import bpe, packing
from tidepanel.llm.queries import vocabulary_path

PATH = vocabulary_path()
TEXTS = [
    (1, "The quick brown fox, isn't it? It'll be 2024."),
    (2, None),
    (3, ""),
    (4, "   \t\n "),
    (5, "naïve façade ÀÉÎ ß straße … — “quoted” 日本語 العربية é ́lone"),
    (6, "<|endoftext|> and <|startoftext|>x <|ENDOFTEXT|>"),
    (7, "word " * 9000),
    (1, "The quick brown fox, isn't it? It'll be 2024."),
    (None, "no id\x1cbut\x0bbreaks and blanks"),
]


def rows(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1.0) for i, t in texts], "doc_id long, text string, ids string, check double")


def digest(ids):
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_as_the_library_does(text):
    text = text.encode("utf-8", "ignore").decode()
    want = bpe.load_tokenizer(PATH).encode(text, add_special_tokens=False).ids
    got = np.frombuffer(bpe.WordEncoder(PATH, 3, 3).text(text.encode()), "<u4").tolist()
    assert got == want


def test_memory_forgets_and_ids_stay():
    small, large = bpe.WordEncoder(PATH, 2, 2), bpe.WordEncoder(PATH)
    text = b"one two three four one two three four five one"
    assert small.text(text) == large.text(text) == small.text(text)


def test_encode_documents(spark):
    got = bpe.encode_documents(rows(spark, TEXTS), PATH, with_ids=True).collect()
    tokenizer = bpe.load_tokenizer(PATH)
    want = []
    for i, t in TEXTS:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), digest(ids), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r)[:4] for r in got), key=key) == sorted(want, key=key)
    assert all(digest(r["ids"]) == r["ids_sha256"] for r in got)


def test_pieces_come_from_the_join(spark, monkeypatch):
    """What decodes is the vocabulary table: another one gives other texts, and many buckets give the same as few."""
    docs = rows(spark, TEXTS)
    before = sorted(map(str, bpe.encode_documents(docs, PATH).collect()))
    monkeypatch.setattr(bpe, "BUCKET_TEXT", 1000)
    assert sorted(map(str, bpe.encode_documents(docs, PATH).collect())) == before
    table = bpe.vocabulary_table
    monkeypatch.setattr(bpe, "vocabulary_table", lambda spark, path: table(spark, path).selectExpr("id", "concat('<', id, '>') as piece"))
    for r in bpe.encode_documents(docs, PATH, with_ids=True).collect():
        assert r["decoded_sha256"] == hashlib.sha256(" ".join(f"<{i}>" for i in r["ids"]).encode()).hexdigest()


def test_bitmaps_of_ids():
    ids = np.array([0, 7, 32767, 32768, 49407, 70000])
    batch = pa.RecordBatch.from_pylist([{"block": 5, **b} for b in bpe._bitmaps(ids)], schema=pa.schema([("block", pa.int64()), ("page", pa.int32()), ("bits", pa.binary())]))
    got = [(r["block"], r["id"]) for b in bpe._set_bits(iter([batch])) for r in b.to_pylist()]
    assert got == [(5, i) for i in ids.tolist()]


def test_decode_round_trip(spark):
    ids = bpe.encode_documents(rows(spark, TEXTS[:5]), PATH, with_ids=True)
    vocabulary = spark.createDataFrame([(i, p.decode()) for i, p in enumerate(bpe.pieces_by_id(PATH))], "id int, piece string")
    for r in bpe.decode_ids(ids.select("doc_id", "ids", "decoded_sha256"), vocabulary).join(ids, "doc_id").collect():
        assert hashlib.sha256(r["decoded"].encode()).hexdigest() == r["decoded_sha256"]


def test_empty_table(spark):
    empty = rows(spark, []).limit(0)
    assert bpe.encode_documents(empty, PATH).count() == 0
    assert packing.pack_documents(empty, PATH).count() == 0


def test_changed_table_is_an_error(spark, monkeypatch):
    docs = rows(spark, TEXTS[:1])
    original = bpe._list_words
    monkeypatch.setattr(bpe, "_list_words", lambda *a: lambda batches: (b.set_column(2, "check", pa.array([7], pa.int64())) for b in original(*a)(batches)))
    with pytest.raises(Exception, match="changed between two scans"):
        bpe.encode_documents(docs, PATH)


def unpack(found, texts):
    """Checks places and ids; gives the number of sequences."""
    tokenizer = bpe.load_tokenizer(PATH)
    at = {}
    for r in found:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    by_doc = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts}
    for r in found:
        own = by_doc[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"] and r["start"] == 4096 * r["piece"]
    assert sum(r["length"] for r in found) == sum(len(by_doc[i]) for i, _ in texts)
    return len(at)


def test_pack_documents(spark):
    assert unpack(packing.pack_documents(rows(spark, TEXTS), PATH).collect(), TEXTS) == 3


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 9), max_size=12))
def test_plan_is_whole_and_no_worse_than_best_fit(histogram):
    before = packing.best_fit(histogram, 50).classes()
    after = packing.plan(histogram, 50)
    for classes in (before, after):
        seen = {}
        for pattern, bins in classes:
            assert sum(n * c for n, c in pattern) <= 50
            for n, c in pattern:
                seen[n] = seen.get(n, 0) + c * bins
        assert seen == histogram
    assert sum(b for _, b in after) <= sum(b for _, b in before)


def test_search_empties_a_bin():
    # Best fit decreasing needs three bins: 6+3, 5+5... a swap makes room.
    bins = packing.Bins(10)
    for pattern in (((6, 1), (3, 1)), ((5, 1), (2, 1)), ((4, 1),)):
        bins.add(pattern, 1)
    assert sum(b for _, b in packing.local_search(bins).classes()) == 2


def exchanges_left(classes, capacity):
    """Whether two bins are left of which the fuller can gain by 0, 1 or 2 pieces for one, or one for two."""
    bins = [(capacity - sum(n * c for n, c in p), k, [n for n, c in p for _ in range(c)], many) for k, (p, many) in enumerate(classes)]
    bins = [b for b in bins if b[0]]
    give = {1: [], 2: []}
    for free, k, own, _ in bins:
        give[1] += [(n, free, k) for n in own]
        give[2] += [(a + b, free, k) for i, a in enumerate(own) for b in own[:i]]
    give = {k: np.array(v, np.int64).reshape(-1, 3) for k, v in give.items()}
    for free, k, own, many in bins:
        outs = {(1, 0), *((1, n) for n in own), *((2, n) for n in own), *((1, a + b) for i, a in enumerate(own) for b in own[:i])}
        for pieces, out in outs:
            x = give[pieces]
            if ((x[:, 0] > out) & (x[:, 0] <= out + free) & (x[:, 1] >= free) & ((x[:, 2] != k) | (many > 1))).any():
                return True
    return False


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 9), max_size=12))
def test_search_ends_where_no_exchange_is_left(histogram):
    assert not exchanges_left(packing.plan(histogram, 50), 50)


def test_search_of_many_classes_goes_on_to_the_end():
    lengths, counts = np.unique(np.random.default_rng(1).integers(1024, 2049, 20_000), return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    before = sum(b for _, b in packing.best_fit(histogram, 4096).classes())
    after = packing.plan(histogram)
    assert {n: sum(c * b for p, b in after for m, c in p if m == n) for n in histogram} == histogram
    assert not exchanges_left(after, 4096)
    assert sum(b for _, b in after) < 0.97 * before


def fewest_bins(lengths, capacity):
    """The least number of bins, by trying every bin for every piece."""
    best = len(lengths)

    def place(k, frees):
        nonlocal best
        if len(frees) >= best:
            return
        if k == len(lengths):
            best = len(frees)
            return
        for free in sorted({f for f in frees if f >= lengths[k]}):
            rest = list(frees)
            rest.remove(free)
            place(k + 1, [*rest, free - lengths[k]])
        place(k + 1, [*frees, capacity - lengths[k]])

    place(0, [])
    return best


def test_bins_against_the_fewest_possible():
    rng = np.random.default_rng(8)
    same = 0
    for _ in range(150):
        lengths = sorted(rng.integers(1, 21, rng.integers(1, 10)).tolist(), reverse=True)
        least = fewest_bins(lengths, 20)
        found = sum(b for _, b in packing.plan({n: lengths.count(n) for n in set(lengths)}, 20))
        assert least <= found <= least + 1
        same += found == least
    assert same >= 145


def test_clashing_names_of_packed_rows(spark):
    rows = spark.createDataFrame([(3, 1, "a"), (4096, 2, "b"), (3, 1, "a")], "length long, sequence_id int, _Task string")
    got = packing.pack(rows)
    assert got.columns == ["length", "sequence_id", "_Task", "sequence_id_", "offset"]
    assert sorted((r[0], r[1], r[2], r[4]) for r in got.collect()) == [(3, 1, "a", 0), (3, 1, "a", 3), (4096, 2, "b", 0)]


def test_one_length_in_all_rows(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'same text here' as text").repartition(7)
    found = packing.pack_documents(docs, PATH)
    assert found.select("sequence_id").distinct().count() == -(-5000 * 4 // 4096)
    assert found.groupBy("sequence_id", "offset").count().where("count > 1").count() == 0
