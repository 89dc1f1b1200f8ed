import random
import re
import zlib
from collections import Counter

import pytest

from tidepanel.llm import spelling
from tidepanel.llm.queries import slip

RNG = random.Random(11)


def plain(docs, change=True):
    """The contract by plain loops."""
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if change and h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    return plain_groups(n)


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(n):
    near = {w: [o for o in n if o != w and one_apart(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows(df):
    got = df.collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got}
    assert len(out) == len(got)
    return out


def edited(word):
    k = RNG.randrange(len(word))
    return RNG.choice([word[:k] + word[k + 1 :], word[:k] + RNG.choice("abé÷") + word[k:], word[:k] + RNG.choice("abÿ×") + word[k + 1 :]])


def test_documents_by_plain_loops(spark):
    stems = ["retention", "Ünïcode", "aaaaaaaa", "abababab", "Straße", "listening", "silentings"] + ["".join(RNG.choices("abc", k=7)) for _ in range(30)]
    docs = [(k, " ".join(RNG.choices(stems, k=80)) + " " + " ".join(edited(RNG.choice(stems)) for _ in range(40))) for k in range(60)]
    docs += [(None, "Retention,retention;retention" * 3), (900, None), (901, ""), (902, "x" * 5000 + " " + "listening " * 3000), (902, "listening listeninG")]
    docs += [(903, ("y" * 3000 + " " + "y" * 2999 + "z ") * 5)]
    table = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    got = rows(spelling.group_variants(spelling.count_words(table, change=slip)))
    assert got == plain(docs)
    assert any(r[1] for r in got) and any(r[4] > 3 for r in got)


def test_chains_are_followed_to_their_ends(spark):
    """Forms of forms, over more steps than rounds."""
    n, word, count = {}, "abcdefgh", 5
    for k in range(9):
        n[word] = count
        word, count = word[:k] + chr(ord("q") + k) + word[k + 1 :] if k < 8 else word, count * 5
    got = rows(spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long")))
    assert got == plain_groups(n) and len({r[2] for r in got}) == 1


def test_any_code_points_and_repeated_letters(spark):
    n = {w: RNG.randint(5, 500) for w in ["aaaaaa", "aaaaaaa", "aaaaaaaa", "aaabaaa", "𝔘𝔫𝔦𝔠𝔬𝔡", "𝔘𝔫𝔦𝔠𝔬𝔡𝔢", "𝔘𝔫𝔦𝔠𝔬𝔢", "abcdef", "fedcba", "abcdfe", "bbcdef"]}
    assert rows(spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long"))) == plain_groups(n)


def test_a_word_with_very_many_variants(spark):
    """A frequent word whose variants are a third of all words is no group in one task and loses none."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    n = {"frequent": 9000}
    for k in range(8):
        for c in letters:
            n.setdefault("frequent"[:k] + c + "frequent"[k + 1 :], 5)
            n.setdefault("frequent"[:k] + c + "frequent"[k:], 6)
    got = rows(spelling.group_variants(spark.createDataFrame(list(n.items()), "word string, n long").repartition(7)))
    assert got == plain_groups(n)
    assert [r[4] for r in got if r[0] == "frequent"] == [len(n) - 1]


def test_empty_and_wrong_ratio(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_variants(spelling.count_words(none)).collect() == []
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([], "word string, n long"), ratio=1)
