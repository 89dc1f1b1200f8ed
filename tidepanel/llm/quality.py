"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages; only the document has a label. Every passage
is encoded (byte profile and word statistics, then a learned layer), gated
attention weights say how much each passage counts, and the weighted passage
representation is scored. All weights are learned together from document
labels, by stochastic gradient steps on the driver, over a bounded sample of
labelled documents: the lowest by a hash of the id of all labelled rows, at
most ``SAMPLE`` of them and only as long as those before hold less than
``SAMPLE_TEXT`` bytes of text. Features of the sample are made on the
executors; texts of any length are read whole for learning and scoring alike.
The driver holds some 100 bytes for a byte of text at worst (words of one
letter), 15 usually.

Null and empty texts are one empty passage and get a score like any other.
Repeated rows get a row each. Labels other than 0 and 1, null labels and
labels without a document teach nothing; of contradicting labels of one id
the higher counts. Without both labels in the sample every score is the share
of ones (one half if there are none). Empty tables give empty results; extra
columns are ignored. Equal scores need no order, and equal hashes of ids go by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import slices, text_bytes, tidy

PASSAGE_WORDS = 64
SAMPLE, SAMPLE_TEXT = 3000, 12 << 20
HIDDEN, GATES = 24, 12
EPOCHS, RATE, DECAY, SEED = 40, 0.01, 1e-4, 7
_EXTRA = 6
FEATURES = 256 + _EXTRA


def passages(text: bytes, words: int = PASSAGE_WORDS) -> np.ndarray:
    """Features of every passage of a text, one row each."""
    found = text.split()
    parts = [found[i : i + words] for i in range(0, len(found), words)] or [[]]
    # A short rest says little by itself; it joins the passage before.
    if len(parts) > 1 and len(parts[-1]) < words // 2:
        parts[-2:] = [parts[-2] + parts[-1]]
    joined = [b" ".join(p) for p in parts]
    size = np.fromiter(map(len, joined), np.int64, len(joined))
    data = np.frombuffer(b"".join(joined), np.uint8).astype(np.int64)
    data += np.repeat(np.arange(len(joined)) << 8, size)
    counts = np.bincount(data, minlength=len(joined) << 8).reshape(-1, 256)
    out = np.empty((len(joined), FEATURES), np.float32)
    total = np.maximum(size, 1)
    out[:, :256] = np.sqrt(counts / total[:, None])
    n = np.fromiter(map(len, parts), np.int64, len(parts))
    seen: set[bytes] = set()
    for k, p in enumerate(parts):
        own = set(p)
        out[k, 256] = len(own) / max(1, len(p))
        out[k, 257] = len(own - seen) / max(1, len(own))
        seen |= own
    out[:, 258] = np.log1p(n) / 4
    out[:, 259] = size / np.maximum(n, 1) / 10
    out[:, 260] = n == 0
    out[:, 261] = np.log1p(len(parts)) / 4
    return out


class Model:
    """Encoder, gated attention and scorer; ``score`` is the probability of label 1."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    def score(self, x: np.ndarray) -> float:
        w = self.w
        if "prior" in w:
            return float(w["prior"])
        h = np.maximum(((x - w["mean"]) / w["std"]) @ w["E"] + w["e"], 0)
        a = (np.tanh(h @ w["V"] + w["v"]) / (1 + np.exp(-(h @ w["U"] + w["u"])))) @ w["a"]
        a = np.exp(a - a.max())
        z = (a / a.sum()) @ h
        return float(1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -30, 30))))


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Learn from bags of passage features and their 0/1 labels."""
    labels = np.asarray(labels, np.float64)
    ones = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or ones in (0.0, 1.0):
        return Model({"prior": np.float64(ones)})
    rng = np.random.default_rng(seed)
    # One array of all passages, scaled where it is; bags are parts of it.
    every = np.concatenate(bags)
    ends = np.cumsum([len(x) for x in bags])
    mean = every.mean(0, dtype=np.float64)
    spread = sum(((every[i : i + 4096] - mean) ** 2).sum(0) for i in range(0, len(every), 4096)) / len(every)
    w = {"mean": mean.astype(np.float32), "std": np.maximum(np.sqrt(spread), 0.02).astype(np.float32)}
    every -= w["mean"]
    every /= w["std"]
    bags = np.split(every, ends[:-1])
    d, h, g = every.shape[1], HIDDEN, GATES
    p = {"E": rng.normal(0, d**-0.5, (d, h)), "e": np.zeros(h), "V": rng.normal(0, h**-0.5, (h, g)), "v": np.zeros(g), "U": rng.normal(0, h**-0.5, (h, g)), "u": np.zeros(g), "a": rng.normal(0, g**-0.5, g), "c": rng.normal(0, h**-0.5, h), "b": np.zeros(())}
    m, s = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    # Both labels weigh alike in the loss up to a factor that leaves the prior in the score.
    weigh = np.where(labels == 1, 1.0, (ones / (1 - ones)) ** 0.5)
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + 1e-4
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            own = order[at : at + 64]
            x = np.concatenate([bags[i] for i in own])
            size = np.array([len(bags[i]) for i in own])
            first = np.cumsum(size) - size
            doc = np.repeat(np.arange(len(own)), size)
            pre = x @ p["E"] + p["e"]
            hid = np.maximum(pre, 0)
            t, q = np.tanh(hid @ p["V"] + p["v"]), 1 / (1 + np.exp(-(hid @ p["U"] + p["u"])))
            r = (t * q) @ p["a"]
            r = np.exp(r - np.maximum.reduceat(r, first)[doc])
            att = r / np.add.reduceat(r, first)[doc]
            z = np.add.reduceat(att[:, None] * hid, first)
            y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
            dy = (y - labels[own]) * weigh[own] / len(own)
            dz = dy[:, None] * p["c"]
            da = (dz[doc] * hid).sum(1)
            dr = att * (da - np.add.reduceat(att * da, first)[doc])
            dtq = dr[:, None] * p["a"]
            dt, dq = dtq * q * (1 - t * t), dtq * t * q * (1 - q)
            dh = (att[:, None] * dz[doc] + dt @ p["V"].T + dq @ p["U"].T) * (pre > 0)
            grad = {"c": z.T @ dy, "b": dy.sum(), "a": (t * q).T @ dr, "V": hid.T @ dt, "v": dt.sum(0), "U": hid.T @ dq, "u": dq.sum(0), "E": x.T @ dh, "e": dh.sum(0)}
            step += 1
            for k, gk in grad.items():
                gk = gk + DECAY * p[k]
                m[k] = 0.9 * m[k] + 0.1 * gk
                s[k] = 0.999 * s[k] + 0.001 * gk * gk
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return Model(w | {k: np.asarray(x, np.float32) for k, x in p.items()})


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 64):
            bags = [passages(t).astype(np.float16).tobytes() for t in text_bytes(part.column("_text"))]
            yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_label"), pa.array(bags, pa.binary())], names=["id", "label", "bag"])


def _sample(docs: DataFrame, target: DataFrame, sample: int, sample_text: int) -> DataFrame:
    """_id, _label of the documents to learn from: at most ``sample`` rows, so they may be broadcast."""
    sized = docs.groupBy("_id").agg(F.sum(F.coalesce(F.octet_length("_text"), F.lit(0))).alias("_size"))
    first = target.join(sized, "_id").withColumn("_hash", F.xxhash64("_id")).orderBy("_hash", "_id").limit(sample)
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_hash", "_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return first.withColumn("_before", before).where(F.col("_before") < sample_text).select("_id", "_label")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality", text: str = "text", id_column: str = "doc_id", sample_text: int = SAMPLE_TEXT) -> Model:
    """Fit on at most ``sample`` labelled documents, the lowest by a hash of their id, while those before hold less than ``sample_text`` bytes."""
    target = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("long").alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    texts = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).alias("_text"))
    chosen = _sample(texts, target, sample, sample_text)
    # No text is shuffled.
    bags = texts.join(F.broadcast(chosen), "_id").select("_id", "_label", "_text").mapInArrow(tidy(_featurize), "id long, label int, bag binary")
    got = sorted(bags.groupBy("id", "label").agg(F.min("bag").alias("bag")).collect())
    return fit([np.frombuffer(r["bag"], np.float16).reshape(-1, FEATURES).astype(np.float32) for r in got], np.array([r["label"] for r in got]))


def _score(sent, source: str, names: list[str], out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in batches:
            for part in slices(batch):
                scores = [model.score(passages(t)) for t in text_bytes(part.column(source))]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(scores, pa.float64())], names=[*names, out])

    return run


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """Columns ``keep`` and ``out`` (no name of these), the score from 0 to 1, of every row."""
    own = docs.select(*keep, *([] if text in keep else [text]))
    schema = ", ".join(f"`{n}` {own.schema[n].dataType.simpleString()}" for n in keep)
    return own.mapInArrow(tidy(_score(docs.sparkSession.sparkContext.broadcast(model), text, keep, out)), f"{schema}, `{out}` double")
