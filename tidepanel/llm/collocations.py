"""Phrase collocations by pivot partitioning.

Phrases are runs of two to five words within a piece of a text. A phrase belongs
to its *pivot*, its rarest word (of equally rare ones the later in code-point
order).

1. Blocks of documents are tokenized. Distinct words of a block and language
   leave with their counts, packed by hash buckets, and the text as numbers of
   the block's words. Words that occur often enough in a language get dense
   numbers in the order of their counts, so a larger number is a rarer word, and
   buckets answer the blocks.
2. Each word of a block that is frequent is a pivot there. Its fragment is what
   its phrases can reach: up to four words before it that are more frequent and
   up to four words behind it that are not rarer, cut at rare words and at the
   ends of pieces. (A phrase that has its pivot twice is found at the first.)
   Equal fragments of a block become one with a count, and go to the part of
   their pivot. A pivot with very many fragments has several parts, by a hash of
   the fragment.
3. A part is mined for all phrases around its pivots. Rare phrases of pivots with
   one part are left out there; counts of the others are summed up once more.
4. Scores, cuts and containment are joins on the frequent phrases, exact in
   decimals. A phrase is contained in a longer one as often only if it is in one
   that is longer by a word, so two parts of each phrase are looked up.

A block and language send a row to each bucket that they have words for, and a row
or two to each part that they have fragments for; there are as many buckets as
parts, one for each 8 MB of text. So what a task holds is bounded: a block,
or the fragments of a part.

Null text is empty, null language is ``und``. Texts are read whole. Repeated rows
count each. Words may hold any other characters. Ties are settled by the order of
the phrases' bytes. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import from_ipc, task_blocks, text_bytes, tidy, to_ipc
from .tables import drop, materialize, shuffle_partitions

LONGEST = 5
MIN_COUNT = 100
TOP = 2000
UNKNOWN = "und"
BLOCK_TEXT = 8 << 20
#: Bytes of text for which a part is made.
PART_TEXT = 8 << 20
#: A pivot has a part for so many occurrences.
PIVOT_ROWS = 1 << 18
#: Words whose fragments are made at once.
STRETCH = 1 << 18

#: A-Z to a-z; the ends of pieces to full stops; tabs to blanks. No word holds a full stop then.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz......... ")
_TOKENS_DDL = "bucket int, block long, lang string, words binary, text binary"
_TOKENS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("text", pa.binary())])


def _tokens(batches: Iterator[pa.RecordBatch], buckets: int, block_text: int) -> Iterator[pa.RecordBatch]:
    """Of each block and language: a row for each bucket of words (number in the block, word, count), and the text in numbers, where 0 ends a piece."""
    for block, table in task_blocks(batches, "_text", max_bytes=block_text):
        numbers: dict[str, defaultdict] = {}
        texts: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(table.column("_lang").to_pylist(), text_bytes(table.column("_text")), strict=True):
            if lang not in numbers:
                numbers[lang] = defaultdict()
                numbers[lang].default_factory = numbers[lang].__len__
                texts[lang] = [np.full(1, numbers[lang][b"."], np.int32)]
            words = text.translate(_TABLE).replace(b".", b" . ").split()
            texts[lang] += [np.fromiter(map(numbers[lang].__getitem__, words), np.int32, len(words)), np.zeros(1, np.int32)]
        del table
        for lang, parts in texts.items():
            found, text = list(numbers[lang])[1:], np.concatenate(parts)
            rows = [{"bucket": -1, "block": block, "lang": lang, "text": zstandard.compress(text.tobytes(), 3)}]
            bucket = np.fromiter(map(zlib.crc32, found), np.int64, len(found)) % buckets
            order = np.argsort(bucket, kind="stable")
            edges = [*np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist(), len(order)]
            counts = np.bincount(text, minlength=len(found) + 1)
            listed = pa.table({"num": pa.array((order + 1).astype(np.int32)), "word": pa.array(found, pa.binary()).take(pa.array(order)), "count": pa.array(counts[order + 1])})
            rows += [{"bucket": int(bucket[order[a]]), "block": block, "lang": lang, "words": to_ipc(listed.slice(a, b - a))} for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=_TOKENS)


def _summed(min_count: int):
    out = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("f", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket and language: its frequent words, and the sum of all counts without a word."""
        for (_, lang), rows in groupby(_rows(batches, "bucket", "lang", "words"), itemgetter(0, 1)):
            got = pa.concat_tables([from_ipc(r[2]) for r in rows]).group_by("word").aggregate([("count", "sum")])
            often = got.filter(pc.greater_equal(got.column("count_sum"), min_count))
            every = pc.sum(got.column("count_sum")).as_py()
            words, f = [None, *often.column("word").to_pylist()], [every, *often.column("count_sum").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f)), pa.array(words, pa.binary()), pa.array(f)], schema=out)

    return tidy(run)


def _rows(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and language, its frequent words first: for each block the numbers of those it has."""
    out = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("answer", pa.binary())])
    for (_, lang), rows in groupby(_rows(batches, "bucket", "lang", "word", "f", "id", "block", "words"), itemgetter(0, 1)):
        known: list[tuple] = []
        words = numbers = None
        for _, _, word, f, ident, block, payload in rows:
            if payload is None:
                known.append((word, ident, f))
                continue
            if words is None:
                words = pa.array([w for w, _, _ in known], pa.binary())
                numbers = pa.table({"id": pa.array([i for _, i, _ in known], pa.int64()), "f": pa.array([f for _, _, f in known], pa.int64())})
            listed = from_ipc(payload)
            at = pc.index_in(listed.column("word"), value_set=words)
            has = pc.is_valid(at)
            if pc.any(has).as_py():
                met = numbers.take(at.filter(has)).append_column("num", listed.column("num").filter(has))
                yield pa.RecordBatch.from_pylist([{"block": block, "lang": lang, "answer": to_ipc(met)}], schema=out)


def _numbered(words: DataFrame) -> DataFrame:
    """lang, word, f with dense numbers ``id`` from 1, the most frequent first (then by language and word)."""
    placed = words.repartitionByRange(shuffle_partitions(words.sparkSession), F.col("f").desc(), "lang", "word").sortWithinPartitions(F.col("f").desc(), "lang", "word")
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "frequent-words")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row for each partition of the sort, so this window and the broadcast are as small as that.
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    out = placed.join(F.broadcast(before), part == F.col("_part"))
    return out.select("lang", "word", "f", (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).alias("id"))


def _fragments_of(padded: np.ndarray, start: int, stop: int, longest: int) -> np.ndarray:
    """A row for each pivot that has a phrase: the words before it, itself, the words behind it; 0 is none.

    ``padded`` has 0 where phrases end, and ``longest - 1`` more zeros before and
    behind; ``start`` and ``stop`` count without these.
    """
    reach = longest - 1
    pivots = padded[start + reach : stop + reach]
    out = np.zeros((stop - start, 2 * longest - 1), padded.dtype)
    out[:, reach] = pivots
    for step, fits in ((-1, np.less), (1, np.less_equal)):
        more = pivots > 0
        for k in range(step, longest * step, step):
            word = padded[start + reach + k : stop + reach + k]
            more = more & (word > 0) & fits(word, pivots)
            out[:, reach + k] = np.where(more, word, 0)
    return out[(out[:, reach - 1] > 0) | (out[:, reach + 1] > 0)]


def _packed(rows: np.ndarray, width: int) -> np.ndarray:
    """Each row's numbers as bytes, ``width`` to a number, the highest first."""
    n, columns = rows.shape
    return rows.astype(">u8").view(np.uint8).reshape(n, columns, 8)[:, :, 8 - width :].reshape(n, columns * width)


def _numbers(packed: np.ndarray) -> np.ndarray:
    """One number of each row of bytes."""
    out = np.zeros((len(packed), 8), np.uint8)
    out[:, 8 - packed.shape[1] :] = packed
    return out.view(">u8").reshape(-1).astype(np.int64)


def _counted(rows: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of bytes and their summed counts."""
    n, size = rows.shape
    if not n:
        return rows, np.zeros(0, np.int64)
    keys = pa.Array.from_buffers(pa.binary(size), n, [None, pa.py_buffer(np.ascontiguousarray(rows))])
    got = pa.table({"k": keys, "c": pa.array(np.ones(n, np.int64) if counts is None else counts)}).group_by("k").aggregate([("c", "sum")])
    distinct = pa.concat_arrays(got.column("k").chunks)
    return np.frombuffer(distinct.buffers()[1], np.uint8, len(distinct) * size).reshape(-1, size), got.column("c_sum").to_numpy()


def _mixed(values: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit numbers."""
    x = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_SENT_DDL = "part int, whole boolean, payload binary, counts binary"
_SENT = pa.schema([("part", pa.int32()), ("whole", pa.bool_()), ("payload", pa.binary()), ("counts", pa.binary())])


def _routed(rows: np.ndarray, counts: np.ndarray, ids: np.ndarray, often: np.ndarray, parts: int, width: int, longest: int, pivot_rows: int) -> pa.RecordBatch:
    """Fragments by part; ``whole``: of pivots that have one part."""
    reach = longest - 1
    pivots = _numbers(rows[:, reach * width : (reach + 1) * width])
    shares = -(-often[np.searchsorted(ids, pivots)] // pivot_rows)
    salt = np.zeros(len(rows), np.uint64)
    for k in np.flatnonzero(shares > 1).tolist():
        salt[k] = zlib.crc32(rows[k]) % int(shares[k])
    part = ((_mixed(pivots) + salt) % np.uint64(parts)).astype(np.int64)
    key = part * 2 + (shares == 1)
    order = np.argsort(key, kind="stable")
    key, rows, counts = key[order], rows[order], counts[order]
    edges = [*np.flatnonzero(np.diff(key, prepend=-1)).tolist(), len(key)]
    out = [
        {"part": int(key[a]) // 2, "whole": bool(key[a] % 2), "payload": zstandard.compress(rows[a:b].tobytes(), 1), "counts": zstandard.compress(counts[a:b].astype("<i8").tobytes(), 1)}
        for a, b in zip(edges[:-1], edges[1:], strict=True)
    ]
    return pa.RecordBatch.from_pylist(out, schema=_SENT)


def _send(parts: int, width: int, longest: int, pivot_rows: int):
    """Rows of a block and language, its answers (num, id, f) before its text, to fragments."""

    def fragments(text: np.ndarray, answers: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = np.zeros(max(int(text.max()), int(answers[:, 0].max())) + 1, np.int64)
        ids[answers[:, 0]] = answers[:, 1]
        reach = np.zeros(longest - 1, np.int64)
        padded = np.concatenate((reach, ids[text], reach))
        made = [_packed(_fragments_of(padded, a, min(len(text), a + STRETCH), longest), width) for a in range(0, len(text), STRETCH)]
        del padded
        rows, counts = _counted(np.concatenate(made))
        del made
        if len(rows):
            known = answers[np.argsort(answers[:, 1])]
            yield _routed(rows, counts, known[:, 1], known[:, 2], parts, width, longest, pivot_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches, "block", "lang", "answer", "text"), itemgetter(0, 1)):
            held = []
            for _, _, answer, text in rows:
                if text is None:
                    found = from_ipc(answer)
                    held.append(np.stack([found.column(c).to_numpy().astype(np.int64) for c in ("num", "id", "f")], axis=1))
                elif held:
                    yield from fragments(np.frombuffer(zstandard.decompress(text), np.int32), np.concatenate(held))

    return tidy(run)


_MINED_DDL = "phrase binary, a long"
_MINED = pa.schema([("phrase", pa.binary()), ("a", pa.int64())])


def _mined(rows: np.ndarray, counts: np.ndarray, longest: int, least: int) -> Iterator[pa.RecordBatch]:
    """The phrases around the pivots of fragments that occur ``least`` times."""
    reach = longest - 1
    rows, counts = _counted(rows, counts)
    width = rows.shape[1] // (2 * longest - 1)
    there = rows.reshape(len(rows), 2 * longest - 1, width).any(axis=2)
    for length in range(2, longest + 1):
        found, weights = [], []
        for before in range(length):
            first = reach - before
            has = np.flatnonzero(there[:, first] & there[:, first + length - 1])
            found.append(rows[has, first * width : (first + length) * width])
            weights.append(counts[has])
        phrases, sums = _counted(np.concatenate(found), np.concatenate(weights))
        often = np.flatnonzero(sums >= least)
        for a in range(0, len(often), 50_000):
            some = often[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in phrases[some]], pa.binary()), pa.array(sums[some])], schema=_MINED)


def _mine(width: int, longest: int, min_count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by part, then by whether their pivots are whole."""

        def part(held: list[tuple[bytes, bytes]], whole: bool) -> Iterator[pa.RecordBatch]:
            rows = np.concatenate([np.frombuffer(zstandard.decompress(p), np.uint8).reshape(-1, (2 * longest - 1) * width) for p, _ in held])
            counts = np.concatenate([np.frombuffer(zstandard.decompress(c), "<i8") for _, c in held])
            yield from _mined(rows, counts, longest, min_count if whole else 1)

        held: list[tuple[bytes, bytes]] = []
        now = None
        for batch in batches:
            for own, whole, payload, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "whole", "payload", "counts")), strict=True):
                if held and (own, whole) != now:
                    yield from part(held, now[1])
                    held = []
                now = (own, whole)
                held.append((payload, counts))
        if held:
            yield from part(held, now[1])

    return tidy(run)


def _number_key(column: str, width: int):
    return F.unhex(F.lpad(F.hex(column), 2 * width, "0"))


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Four things: phrases (phrase, a), words (lang, word, f, id), sizes (lang, n) and the bytes to a number.

    A phrase is the concatenation of its words' ids, each of so many bytes.
    """
    if longest < 2 or min_count < 1:
        raise ValueError("phrases have two words at least and occur once at least")
    spark = docs.sparkSession
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("_lang"), F.col(text).alias("_text"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // PART_TEXT))
    tokens = materialize(named.mapInArrow(tidy(partial(_tokens, buckets=parts, block_text=BLOCK_TEXT)), _TOKENS_DDL), "tokens")
    listed = tokens.where("bucket >= 0").select("bucket", "lang", "block", "words")
    summed = listed.repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket", "lang").mapInArrow(_summed(min_count), "lang string, word binary, f long")
    totals = materialize(summed, "word-counts")
    sizes = totals.where("word is null").groupBy("lang").agg(F.sum("f").alias("n"))
    words = materialize(_numbered(totals.where("word is not null")), "words")
    width = max(1, (words.count().bit_length() + 7) // 8)
    known = words.select((F.crc32("word") % parts).cast("int").alias("bucket"), "lang", "word", "f", "id")
    both = known.unionByName(listed, allowMissingColumns=True).repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket", "lang", F.col("words").isNotNull())
    answers = both.mapInArrow(tidy(_answers), "block long, lang string, answer binary")
    texts = tokens.where("bucket < 0").select("block", "lang", "text")
    met = answers.unionByName(texts, allowMissingColumns=True).repartition(parts, "block", "lang").sortWithinPartitions("block", "lang", F.col("text").isNotNull())
    sent = met.mapInArrow(_send(parts, width, longest, PIVOT_ROWS), _SENT_DDL)
    mined = sent.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "whole").mapInArrow(_mine(width, longest, min_count), _MINED_DDL)
    phrases = materialize(mined.groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count), "phrases")
    drop(tokens)
    return phrases, words, sizes, width


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int | None = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases, the highest scores first.

    a, l and r are the occurrences of the phrase and of the two parts at its
    weakest cut, n the words of the language, score floor(1000 a n / (l r)).
    Phrases that a longer frequent phrase always contains are left out. ``top``
    None gives all.
    """
    phrases, words, sizes, width = frequent_phrases(docs, longest, min_count, text, lang)
    length = F.octet_length("phrase") / width
    longer = phrases.where(length > 2)
    inside = [F.expr(f"substring(phrase, 1, octet_length(phrase) - {width})"), F.expr(f"substring(phrase, {width + 1})")]
    covered = longer.select(F.explode(F.array(*inside)).alias("phrase"), "a").distinct()
    own = phrases.join(covered.hint("merge"), ["phrase", "a"], "left_anti")
    counts = phrases.unionByName(words.select(_number_key("id", width).alias("phrase"), F.col("f").alias("a")))
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), (length - 1).cast("int"))))
    cuts = cuts.withColumn("_first", F.expr(f"substring(phrase, 1, k * {width})")).withColumn("_rest", F.expr(f"substring(phrase, k * {width} + 1)"))
    for part, name in (("_first", "l"), ("_rest", "r")):
        cuts = cuts.join(counts.select(F.col("phrase").alias(part), F.col("a").alias(name)).hint("merge"), part)
    places = own.withColumn("_at", F.explode(F.sequence(F.lit(1), length.cast("int")))).withColumn("_id", F.expr(f"substring(phrase, (_at - 1) * {width} + 1, {width})"))
    named = places.join(words.select(_number_key("id", width).alias("_id"), "lang", F.col("word").cast("string").alias("word")).hint("merge"), "_id")
    texts = named.groupBy("phrase").agg(F.first("lang").alias("lang"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "word"))), lambda x: x["word"]), " ").alias("words"))
    texts = texts.join(sizes.hint("merge"), "lang")
    scored = cuts.join(texts.hint("merge"), "phrase").select("lang", F.col("words").alias("phrase"), "a", "l", "r", "n", "k", F.expr("(1000BD * cast(a as decimal(18,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))").alias("score"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = weakest.withColumn("rank", F.row_number().over(order))
    ranked = ranked.where(F.col("rank") <= top) if top is not None else ranked
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
