import random
import re
from collections import Counter, defaultdict

import pytest

from tidepanel.llm import collocations

RNG = random.Random(12)
WORDS = ["the", "of", "a", "É", "é", "x-y", " nb", "(q)", "tidal", "panel", "rare1", "the", "the", "of"]


def plain(docs, least, longest=5):
    """The contract by plain loops and whole numbers."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i : i + m])] += 1
    out = set()
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= least}
        rows = []
        for p, a in often.items():
            if len(p) < 2 or any(len(q) > len(p) and c >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in often.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:2000], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def rows(df):
    got = [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()]
    assert len(set(got)) == len(got)
    return set(got)


def corpus():
    docs = []
    for k in range(150):
        text = ""
        for _ in range(RNG.randint(0, 60)):
            text += RNG.choice(WORDS) + RNG.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " the of a "])
        docs.append((text, RNG.choice(["en", "en", "fr", None])))
    docs += [(None, "en"), ("", None), ("The THE the the the the", "en"), ("one very hot line of words, " * 500, "en"), ("aa bb " * 300, "")]
    docs += [("a hot line\n", "en")] * 200
    RNG.shuffle(docs)
    return docs


@pytest.mark.parametrize("split", [False, True])
def test_documents_by_plain_loops(spark, monkeypatch, split):
    """``split``: pivots in many parts, blocks of a few documents."""
    if split:
        monkeypatch.setattr(collocations, "PIVOT_ROWS", 5)
        monkeypatch.setattr(collocations, "BLOCK_TEXT", 2000)
        monkeypatch.setattr(collocations, "STRETCH", 7)
    docs = corpus()
    table = spark.createDataFrame([(t, la, "x", 1) for t, la in docs], "text string, lang string, phrase string, word int").repartition(3)
    got = rows(collocations.collocations(table, min_count=4))
    assert got == plain(docs, 4) and len(got) > 100


def test_more_ids_than_a_byte_and_other_lengths(spark):
    docs = [(" ".join(f"w{RNG.randint(0, 400)}" if RNG.random() < 0.5 else "z" for _ in range(400)), "en") for _ in range(30)]
    table = spark.createDataFrame(docs, "text string, lang string")
    for longest in (2, 3):
        assert rows(collocations.collocations(table, longest=longest, min_count=3)) == plain(docs, 3, longest)


def test_products_beyond_64_bits(spark, monkeypatch):
    """Scores are exact where 1000 a n passes 2^63."""
    big = 3_000_000_007
    phrases = spark.createDataFrame([(bytearray([1, 2]), big)], "phrase binary, a long")
    words = spark.createDataFrame([("en", bytearray(b"p"), 2 * big, 1), ("en", bytearray(b"q"), 3 * big, 2)], "lang string, word binary, f long, id long")
    sizes = spark.createDataFrame([("en", 10**13 + 7)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a: (phrases, words, sizes, 1))
    assert rows(collocations.collocations(None)) == {("en", 1, "p q", big, 2 * big, 3 * big, 10**13 + 7, 1000 * big * (10**13 + 7) // (6 * big * big))}


def test_top_and_empty(spark):
    docs = [(f"a{k} b{k} " * (k + 3), "en") for k in range(9)]
    table = spark.createDataFrame(docs, "text string, lang string")
    every = rows(collocations.collocations(table, min_count=3, top=None))
    assert rows(collocations.collocations(table, min_count=3, top=4)) == {r for r in every if r[1] <= 4}
    assert collocations.collocations(table.limit(0)).collect() == []
    assert collocations.collocations(spark.createDataFrame([("too rare", "en")], "text string, lang string")).collect() == []
