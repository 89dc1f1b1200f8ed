import math
import random

import numpy as np
import pytest

from tidepanel.llm import language_id, quality

WORDS = {
    "en": "the and with this that where which would through night house water over under people".split(),
    "de": "der und mit das nicht schon durch nacht haus wasser über unter menschen werden eine".split(),
    "fr": "le et avec cette que dans nuit maison eau être sous gens vous nous déjà".split(),
    "es": "el y con esta que donde noche casa agua ser bajo gente vosotros nosotros niño".split(),
}


def sentences(rng, lang, n):
    return " ".join(rng.choices(WORDS[lang], k=n))


def test_families_then_languages(spark):
    rng = random.Random(1)
    rows = [(k, sentences(rng, lang, 30), lang) for k, lang in enumerate(list(WORDS) * 40)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    model = language_id.learn(docs)
    assert sorted(model.names) == ["germanic", "romance"] and model.families["romance"] == ["es", "fr"]
    fresh = [(k, sentences(rng, lang, 12), lang) for k, lang in enumerate(list(WORDS) * 20)]
    new = spark.createDataFrame(fresh + [(900, None, "en"), (901, "", "en"), (902, "12 +- ?! ²", None), (903, "É", "fr"), (0, fresh[0][1], "x"), (904, "the night " * 20_000, None)], "doc_id long, text string, lang string")
    got = language_id.predict(new, model, ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(fresh) + 6
    assert np.mean([by[k]["lang_pred"] == lang for k, _, lang in fresh]) >= 0.95
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (900, 901, 902))
    assert by[904]["lang_pred"] == "en" and by[903]["lang_pred"] in WORDS
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    assert language_id.predict(docs, model, ["doc_id"]).collect()[0]["lang_pred"] == "und"
    one = language_id.learn(docs.selectExpr("doc_id", "text", "'xx' as lang"))
    assert language_id.predict(docs, one, docs.columns).collect()[0]["lang_pred"] == "xx"
    assert language_id.predict(docs.limit(0), one, ["doc_id"]).count() == 0


def test_sample_is_bounded(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(k, sentences(rng, "en", 9), "en") for k in range(400)] + [(7, "der und", "de")], "doc_id long, text string, lang string")
    assert language_id.learn(docs, sample=50).families == {"germanic": ["de", "en"]}


def test_no_language_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(language_id, "fit", lambda spark, x, names: names)
    docs = spark.range(450 * 30).selectExpr("id as doc_id", "concat('some words ', char(97 + id % 26)) as text", "concat('l', id % 450) as lang")
    learned = language_id.learn(docs)
    assert len(set(learned)) == 450 and len(learned) == 450 * 30
    fewer = language_id.learn(docs, total=450)
    assert len(set(fewer)) == 450 and 450 * 12 < len(fewer) < 450 * 20


def made_language(rng):
    """Words over a few syllables of its own."""
    syllables = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=2)) for _ in range(14)]
    return ["".join(rng.choices(syllables, k=3)) for _ in range(40)]


def test_many_unknown_languages(spark):
    rng = random.Random(8)
    words = {f"x{k:02d}": made_language(rng) for k in range(50)}
    rows = [(k, " ".join(rng.choices(words[c], k=40)), c) for k, c in enumerate(list(words) * 24)]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(c for f in model.families.values() for c in f) == sorted(words)
    assert max(map(len, model.families.values())) <= 8 and len(model.weights) < 50 * 8 / 2 + 16
    fresh = [(k, " ".join(rng.choices(words[c], k=20)), c) for k, c in enumerate(list(words) * 4)]
    got = language_id.predict(spark.createDataFrame(fresh, "doc_id long, text string, lang string"), model, ["lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.95


def test_groups_of_like_profiles():
    rng = np.random.default_rng(4)
    centres = np.eye(4, 30)
    means = np.repeat(centres, 4, axis=0) + rng.normal(size=(16, 30)) / 50
    assert sorted(language_id.like_groups(means, 4)) == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11], [12, 13, 14, 15]]
    assert sorted(map(len, language_id.like_groups(np.ones((11, 3)), 4))) == [2, 3, 3, 3]
    assert language_id.like_groups(np.ones((1, 3)), 1) == [[0]]


def test_tasks_fit_as_the_driver_would(spark):
    rng = np.random.default_rng(9)
    x = rng.random((60, language_id.FEATURES)).astype(np.float16)
    names = ["en", "de", "es"] * 20
    model = language_id.fit(spark, x, names)
    wide, of = x.astype(np.float32), np.array(names)
    assert model.names == ["germanic", "romance"]
    rest = language_id.linear_svm(wide, np.where(of == "es", 1, -1))
    own = np.flatnonzero(of != "es")
    pair = language_id.linear_svm(wide[own], np.where(of[own] == "de", 1, -1))
    assert np.allclose(model.weights[1], rest, atol=1e-5) and np.allclose(model.weights[2], pair, atol=1e-5)


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5)).astype(np.float32)
    x = x[np.abs(x[:, 0] - x[:, 1]) > 0.5]
    y = np.where(x[:, 0] - x[:, 1] > 0, 1, -1)
    w = language_id.linear_svm(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def noisy(rng, n):
    return " ".join(w + rng.choice(["***", "&&&", "%%%"]) for w in rng.choices(WORDS["en"], k=n))


def labelled(rng, n=240):
    rows = []
    for k in range(n):
        good = k % 3 > 0
        text = sentences(rng, "en", rng.randint(20, 300))
        # A bad document has a bad passage, beside good ones.
        rows.append((k, text if good else text + " " + noisy(rng, 70), int(good)))
    return rows


def test_bad_passage_decides(spark):
    rng = random.Random(3)
    rows = labelled(rng)
    docs = spark.createDataFrame([(k, t, 1.0) for k, t, _ in rows] + [(5, rows[5][1], 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(k, q) for k, _, q in rows] + [(0, None), (1, 7), (None, 1), (10_000, 0)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    fresh = labelled(rng, 90)
    new = spark.createDataFrame([(k, t) for k, t, _ in fresh] + [(900, None), (901, ""), (902, "word " * 50_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in quality.score(new, model, ["doc_id"]).collect()}
    assert np.mean([(got[k] >= 0.5) == bool(q) for k, _, q in fresh]) >= 0.95
    assert all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]


def test_all_passages_of_long_documents_are_learned(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda bags, labels: seen.extend(map(len, bags)))
    docs = spark.createDataFrame([(1, "word " * 64 * 700), (2, "word")], "doc_id long, text string")
    quality.learn(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    assert sorted(seen) == [1, 700]


def test_attention_weights_and_gradients():
    """Learning lowers the loss on bags whose label hangs on one passage."""
    rng = np.random.default_rng(5)
    bags = [rng.normal(size=(rng.integers(1, 9), quality.FEATURES)).astype(np.float32) for _ in range(200)]
    labels = np.array([k % 2 for k in range(200)])
    for b, y in zip(bags, labels, strict=True):
        b[rng.integers(len(b)), 3] = 6.0 if y else -6.0
    model = quality.fit(bags, labels)
    assert np.mean([(model.score(b) >= 0.5) == y for b, y in zip(bags, labels, strict=True)]) > 0.97


@pytest.mark.parametrize(("labels", "want"), [([], 0.5), ([1, 1], 1.0), ([0], 0.0)])
def test_one_label_or_none(spark, labels, want):
    docs = spark.createDataFrame([(k, "a b") for k in range(3)], "doc_id long, text string")
    frame = spark.createDataFrame(list(enumerate(labels)), "doc_id long, quality int")
    assert {r["score"] for r in quality.score(docs, quality.learn(docs, frame), ["doc_id"]).collect()} == {want}


def test_passages_cover_the_text():
    text = " ".join(f"w{k}" for k in range(64 * 5 + 10)).encode()
    assert len(quality.passages(text)) == 5 and len(quality.passages(b"")) == 1


def test_votes_by_plain_counting():
    """The family of the largest margin, then most votes, then belief, then the first language."""
    rng = np.random.default_rng(1)
    families = {"a": ["en"], "b": ["es", "fr", "it"], "c": ["pl", "ru"]}
    pairs = {f: [(i, j) for i in range(len(x)) for j in range(i + 1, len(x))] for f, x in families.items()}
    weights = rng.normal(size=(3 + 0 + 3 + 1, language_id.FEATURES + 1)).astype(np.float32)
    model = language_id.Model(families, weights, pairs)
    seen = set()
    for _ in range(60):
        x = rng.random(language_id.FEATURES).astype(np.float32)
        x /= np.sqrt((x * x).sum())
        margin = [float(np.dot(w[:-1].astype(np.float64), x) + w[-1]) for w in weights]
        family = "abc"[max(range(3), key=lambda i: margin[i])]
        languages, first = families[family], {"a": 3, "b": 3, "c": 6}[family]
        votes, belief = dict.fromkeys(languages, 0), dict.fromkeys(languages, 0.0)
        for k, (i, j) in enumerate(pairs[family]):
            p = 1 / (1 + math.exp(-4 * max(-8, min(8, margin[first + k]))))
            votes[languages[i if margin[first + k] >= 0 else j]] += 1
            belief[languages[i]] += p
            belief[languages[j]] += 1 - p
        want = languages[0] if len(languages) == 1 else max(languages, key=lambda c: (votes[c], belief[c], -languages.index(c)))
        got, score = model.predict(x)
        assert got == want and 0 <= score <= 1
        seen.add(got)
    assert len(seen) > 3


def test_attention_by_plain_loops():
    rng = np.random.default_rng(2)
    d, h, g = quality.FEATURES, 3, 2
    w = {"mean": rng.random(d), "std": rng.random(d) + 0.5, "E": rng.normal(size=(d, h)) / 10, "e": rng.normal(size=h), "V": rng.normal(size=(h, g)), "v": rng.normal(size=g), "U": rng.normal(size=(h, g)), "u": rng.normal(size=g), "a": rng.normal(size=g), "c": rng.normal(size=h), "b": np.float64(0.3)}
    x = rng.random((4, d))
    hidden, weight = [], []
    for row in x:
        own = [max(0.0, sum((row[i] - w["mean"][i]) / w["std"][i] * w["E"][i, j] for i in range(d)) + w["e"][j]) for j in range(h)]
        gate = 0.0
        for k in range(g):
            t = math.tanh(sum(own[j] * w["V"][j, k] for j in range(h)) + w["v"][k])
            s = 1 / (1 + math.exp(-(sum(own[j] * w["U"][j, k] for j in range(h)) + w["u"][k])))
            gate += t * s * w["a"][k]
        hidden.append(own)
        weight.append(math.exp(gate))
    z = [sum(a * own[j] for a, own in zip(weight, hidden, strict=True)) / sum(weight) for j in range(h)]
    want = 1 / (1 + math.exp(-(sum(z[j] * w["c"][j] for j in range(h)) + w["b"])))
    assert quality.Model(w).score(x) == pytest.approx(want)


def test_sample_is_bounded_in_text_and_takes_whole_documents(spark):
    docs = spark.createDataFrame([(k, "x" * (10 * k)) for k in range(1, 41)] + [(5, None)], "_id long, _text string")
    target = spark.createDataFrame([(k, k % 2) for k in range(1, 60)], "_id long, _label int")
    order = [r[0] for r in target.where("_id <= 40").selectExpr("_id", "xxhash64(_id) as h").orderBy("h").collect()]
    for sample, size in ((100, 1 << 20), (7, 1 << 20), (100, 900)):
        want, held = [], 0
        for k in order[:sample]:
            if held < size:
                want.append(k)
            held += 10 * k
        assert sorted(r["_id"] for r in quality._sample(docs, target, sample, size).collect()) == sorted(want)
