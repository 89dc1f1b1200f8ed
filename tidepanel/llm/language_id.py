"""Language identification in two steps: the family first, then its languages.

A linear support vector machine for each family against the rest picks the
family; inside it, one-versus-one linear support vector machines vote between
the languages, which are much alike. Features are byte trigrams of the
lower-cased letters, hashed to ``FEATURES`` counts, as square roots of their
shares (vectors of length one).

Learning takes every language, and at most about ``SAMPLE`` documents of each,
drawn by a hash of the id from all that may be learned from; from more than
``SAMPLE_TOTAL / SAMPLE`` languages on it takes fewer of each, so that about
``SAMPLE_TOTAL`` documents are collected, but never fewer than ``SAMPLE_LEAST``.
Features are made on the executors, and so are the machines, each fitted by
dual coordinate descent in one task from the broadcast profiles (8 KB a document).
A language without a known family goes into a group of like ones: the languages'
mean profiles are halved along their principal axis until a group has at most
about the square root of them. So n such languages need some n * sqrt(n) / 2
machines, and a text is held against the families and one group's pairs only.

Null texts and texts without a letter are ``und`` with score 0. Without anything to learn from
every text is ``und``. Texts of any length are read whole; a text's profile
takes some 30 times its size while it is counted. Repeated rows give a row
each, and teach once for each id; ties go to the language that sorts first.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import slices, text_bytes, tidy
from .tables import shuffle_partitions

FEATURES = 4096
SAMPLE = 800
#: Rows in all, beyond which each language has fewer than ``SAMPLE``, and what each has at least.
SAMPLE_TOTAL, SAMPLE_LEAST = 16_000, 16
COST, EPOCHS, SEED = 4.0, 12, 11
UNDETERMINED = "und"

#: Families of languages (fixed values, by ISO 639-1 code).
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca co es fr gl it la oc pt rm ro sc",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tk tr tt ug uz",
    "indo-aryan": "as bn gu hi mr ne or pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "fil id jv mg ms su tl",
    "sinitic": "zh",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = regex.compile(r"\p{L}")
_BLANK = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def family_of(language: str) -> str | None:
    return _FAMILY.get(language.lower().replace("_", "-").split("-")[0])


def features(text: bytes) -> np.ndarray | None:
    """The profile of a UTF-8 text, or None where it has no letter."""
    word = text.decode("utf-8", "replace")
    if not _LETTER.search(word):
        return None
    data = b" " + b" ".join(word.lower().encode().translate(_BLANK).split()) + b" "
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(FEATURES, np.float32)
    mixed = (b[:-2] * np.uint32(65599) + b[1:-1]) * np.uint32(65599) + b[2:]
    mixed = (mixed * np.uint32(2654435761)) >> np.uint32(20)
    counts = np.bincount(mixed, minlength=FEATURES)
    return np.sqrt(counts / len(mixed)).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = COST, epochs: int = EPOCHS, seed: int = SEED) -> np.ndarray:
    """Weights (the last is the bias) of a linear support vector machine for labels -1 and 1.

    Dual coordinate descent for the hinge loss; each class weighs alike.
    """
    rng = np.random.default_rng(seed)
    n = len(y)
    w = np.zeros(x.shape[1] + 1, np.float32)
    a = np.zeros(n)
    norm = (x * x).sum(1) + 1
    upper = np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum()))) * cost
    for _ in range(epochs):
        for i in rng.permutation(n):
            grad = y[i] * (x[i] @ w[:-1] + w[-1]) - 1
            new = min(max(a[i] - grad / norm[i], 0.0), upper[i])
            if new != a[i]:
                w[:-1] += np.float32((new - a[i]) * y[i]) * x[i]
                w[-1] += (new - a[i]) * y[i]
                a[i] = new
    return w


def _logistic(margin):
    return 1 / (1 + np.exp(-4 * np.clip(margin, -8, 8)))


class Model:
    def __init__(self, families: dict[str, list[str]], weights: np.ndarray, pairs: dict[str, list[tuple[int, int]]]):
        self.names = sorted(families)
        self.families = families
        self.pairs = pairs
        self.weights = weights  # families first (unless there is but one), then each family's pairs

    def _margins(self, first: int, end: int, x: np.ndarray) -> np.ndarray:
        return self.weights[first:end, :-1] @ x + self.weights[first:end, -1]

    def predict(self, x: np.ndarray | None) -> tuple[str, float]:
        if x is None or not self.names:
            return UNDETERMINED, 0.0
        at, sure, family = 0, 1.0, self.names[0]
        if len(self.names) > 1:
            at = len(self.names)
            margins = self._margins(0, at, x)
            belief = _logistic(margins)
            best = int(margins.argmax())
            family, sure = self.names[best], float(belief[best] / belief.sum())
        for name in self.names:
            if name == family:
                break
            at += len(self.pairs[name])
        languages = self.families[family]
        if len(languages) == 1:
            return languages[0], sure
        votes, belief = np.zeros(len(languages)), np.zeros(len(languages))
        for m, (i, j) in zip(self._margins(at, at + len(self.pairs[family]), x), self.pairs[family], strict=True):
            votes[i if m >= 0 else j] += 1
            belief[i] += _logistic(m)
            belief[j] += 1 - _logistic(m)
        best = max(range(len(languages)), key=lambda i: (votes[i], belief[i], -i))
        return languages[best], sure * float(belief[best] / (len(languages) - 1))


def like_groups(means: np.ndarray, size: int) -> list[list[int]]:
    """Rows in groups of at most ``size``, by halving along the principal axis; ties go by place."""

    def halve(own: list[int]) -> list[list[int]]:
        if len(own) <= size:
            return [sorted(own)]
        x = means[own] - means[own].mean(0)
        axis = np.linalg.eigh((x @ x.T).astype(np.float64))[1][:, -1]
        # An axis has no sign of its own.
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        order = [own[i] for i in np.argsort(np.round(axis, 9), kind="stable")]
        return halve(order[: len(order) // 2]) + halve(order[len(order) // 2 :])

    return halve(list(range(len(means))))


def group_languages(x: np.ndarray, names: np.ndarray) -> dict[str, list[str]]:
    """Families of the languages that occur: the known ones, and groups of like ones for the rest."""
    families: dict[str, list[str]] = {}
    unknown = []
    for language in sorted(set(names)):
        if family := family_of(language):
            families.setdefault(family, []).append(language)
        else:
            unknown.append(language)
    if unknown:
        means = np.array([x[names == language].mean(0, dtype=np.float32) for language in unknown])
        for k, group in enumerate(like_groups(means, math.ceil(math.sqrt(len(unknown))))):
            families[f"~{k:06d}"] = [unknown[i] for i in group]
    return families


def _fit_some(sent, parts: int):
    """A row k fits the machines k, k + parts, and so on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, code, machines = sent.value
        for batch in batches:
            for first in batch.column(0).to_pylist():
                for m in range(first, len(machines), parts):
                    positive, negative = machines[m]
                    against = np.ones(len(code), bool) if negative is None else np.isin(code, negative)
                    mine = np.isin(code, positive)
                    own = np.flatnonzero(mine | against)
                    w = linear_svm(x[own].astype(np.float32), np.where(mine[own], 1, -1))
                    yield pa.RecordBatch.from_arrays([pa.array([m], pa.int64()), pa.array([w.tobytes()], pa.binary())], names=["machine", "weights"])

    return run


def fit(spark: SparkSession, x: np.ndarray, languages: list[str]) -> Model:
    """Learn from profiles (half precision will do) and their languages; the machines are dealt to tasks."""
    names = np.array(languages, object)
    families = group_languages(x, names)
    number = {language: k for k, language in enumerate(sorted(set(languages)))}
    code = np.array([number[language] for language in languages], np.int32)
    # A machine holds some languages against others, or against all the rest.
    machines: list[tuple[list[int], list[int] | None]] = []
    if len(families) > 1:
        machines += [([number[c] for c in families[f]], None) for f in sorted(families)]
    pairs = {}
    for f in sorted(families):
        pairs[f] = list(combinations(range(len(families[f])), 2))
        machines += [([number[families[f][i]]], [number[families[f][j]]]) for i, j in pairs[f]]
    weights = np.zeros((len(machines), FEATURES + 1), np.float32)
    if machines:
        parts = min(len(machines), max(spark.sparkContext.defaultParallelism, shuffle_partitions(spark)))
        sent = spark.sparkContext.broadcast((x.astype(np.float16), code, machines))
        for r in spark.range(0, parts, 1, parts).mapInArrow(tidy(_fit_some(sent, parts)), "machine long, weights binary").collect():
            weights[r["machine"]] = np.frombuffer(r["weights"], np.float32)
        sent.unpersist()
    return Model(families, weights, pairs)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = [features(t) for t in text_bytes(part.column("_text"))]
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_lang"), pa.array([None if x is None else x.astype(np.float16).tobytes() for x in found], pa.binary())], names=["id", "lang", "profile"])


def learn(docs: DataFrame, sample: int = SAMPLE, text: str = "text", lang: str = "lang", id_column: str = "doc_id", total: int = SAMPLE_TOTAL, least: int = SAMPLE_LEAST) -> Model:
    """Fit on about ``sample`` rows of each language of ``docs`` (exactly all, where there are fewer).

    Where that makes more than ``total`` rows, ``sample`` shrinks to an equal
    share of them, but not below ``least`` rows a language; no language is left out.

    A row is drawn by a hash of its id; the share drawn comes from counts over
    all rows. Of each language at most 1.2 times ``sample`` are kept.
    """
    own = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(id_column).cast("long").alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    counts = own.groupBy("_lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "_lang").collect()
    if not counts:
        return Model({}, np.zeros((0, FEATURES + 1), np.float32), {})
    sample = max(1, min(sample, max(least, total // len(counts))))
    shares = docs.sparkSession.createDataFrame([(r["_lang"], r["_n"]) for r in counts], "_lang string, _n long")
    draw = F.pmod(F.xxhash64(F.col("_id"), F.lit(SEED)), F.lit(1 << 40)) < F.lit(float(1 << 40)) * F.lit(float(sample)) / F.col("_n")
    # One row a language is broadcast; no text is shuffled.
    drawn = own.join(F.broadcast(shares), "_lang").where(draw).select("_id", "_lang", "_text").mapInArrow(tidy(_profiles), "id long, lang string, profile binary")
    unique = drawn.where("profile is not null").groupBy("lang", "id").agg(F.min("profile").alias("profile"))
    hashed = unique.withColumn("hash", F.xxhash64("id", F.lit(SEED + 1)))
    # A surplus goes by another hash of the id than the draw.
    got = sorted(hashed.collect(), key=lambda r: (r["lang"], r["hash"], r["id"] is None, r["id"] or 0))
    kept, seen = [], {}
    for r in got:
        seen[r["lang"]] = seen.get(r["lang"], 0) + 1
        if seen[r["lang"]] <= 1.2 * sample:
            kept.append(r)
    if not kept:
        return Model({}, np.zeros((0, FEATURES + 1), np.float32), {})
    return fit(docs.sparkSession, np.array([np.frombuffer(r["profile"], np.float16) for r in kept]), [r["lang"] for r in kept])


def _predict(sent, source: str, names: list[str], out: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in batches:
            for part in slices(batch):
                found = [model.predict(features(t)) for t in text_bytes(part.column(source))]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[*names, *out])

    return run


def predict(docs: DataFrame, model: Model, keep: list[str], text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` and, by the names in ``out`` (none of these), language and score (0 to 1) of every row.

    Only the text is looked at.
    """
    own = docs.select(*keep, *([] if text in keep else [text]))
    schema = ", ".join(f"`{n}` {own.schema[n].dataType.simpleString()}" for n in keep)
    return own.mapInArrow(tidy(_predict(docs.sparkSession.sparkContext.broadcast(model), text, keep, list(out))), f"{schema}, `{out[0]}` string, `{out[1]}` double")
