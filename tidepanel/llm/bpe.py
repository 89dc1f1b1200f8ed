"""BPE encoding and decoding with a distinct-word table.

A word here is a run of bytes other than ASCII white space. The vocabularies
this operator accepts drop white space and never merge across it, so the ids
of a text are the ids of its words, one after the other. Every distinct word
of the corpus is encoded once:

1. blocks of documents list their distinct words (split in Spark tasks) and
   send them, sorted and numbered, to the bucket of each word's hash;
2. a bucket encodes each of its distinct words once and answers every block
   with ids by word number, and with a bitmap of the ids that it used;
3. the bitmaps of a block are summed up to the block's distinct ids, which a
   join with the vocabulary (id, piece) turns into pieces;
4. at the block, ids join back by position, and pieces decode them.

Word numbers, ids, and at most the vocabulary's pieces a block are shuffled,
besides one compressed copy of the texts; there is no row for a word's
occurrence. A word in a third of all rows is one entry of a block like any
other. A bucket's task remembers its bucket's distinct words; buckets are as
many as the text is times ``BUCKET_TEXT`` long (and as shuffle partitions are),
so that memory does not grow with the corpus. Rows sent are blocks times
buckets, until a row holds a single word; the parameters say where that begins
(a block of 16 MB and 64 MB of text a bucket: some 100,000 words of a block
over as many buckets, at 6 TB).

Null text counts as empty (no ids, empty decoded text). A text of any length is
whole in one block; its ids and digests take some ten times its size in the
task. Repeated rows and ids give a row each, so there are no ties to settle.
Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import KEPT, from_ipc, task_blocks, text_bytes, to_ipc
from .tables import drop, materialize, repeatable_scans, shuffle_partitions

#: Words made of these need no Unicode normalization: printable ASCII and Latin-1 letters.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]*\Z")
#: How the vocabulary's pre-tokenizer cuts such words once they are lower-cased.
_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

#: Byte-level vocabularies show bytes that don't print as characters from 256 on, in order.
_SHOWN = {b: 256 + k for k, b in enumerate([*range(33), *range(127, 161), 173])}
assert array("I").itemsize == 4 and sys.byteorder == "little"


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The tokenizer of a file, without truncation and padding, one copy a process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def pieces_by_id(path: str) -> list[bytes]:
    """The id-to-piece table, special tokens included; ids without a piece are empty."""
    tokenizer = load_tokenizer(path)
    by_id = {i: piece for piece, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    return [by_id.get(i, "").encode() for i in range(max(by_id) + 1)]


class Memory:
    """A bounded map of two generations: what is used again in time survives, the rest goes."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        if (found := self.young.get(key)) is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class WordEncoder:
    """Words to ids (little-endian unsigned 32 bits), with bounded memories of words and of runs of letters.

    ``words`` and ``runs`` bound the memories (twice as many entries at most);
    forgetting costs time and never changes an id.
    """

    def __init__(self, path: str, words: int = 80_000, runs: int = 200_000):
        self.tokenizer = load_tokenizer(path)
        self.words = Memory(words)
        self.runs = Memory(runs)

    def _encode(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, word: bytes) -> bytes:
        if (ids := self.words.get(word)) is None:
            ids = self.fresh(word)
            self.words.put(word, ids)
        return ids

    def fresh(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if text.isascii():
            if text.isalpha():
                return self._run(text.lower())
            plain = text.isprintable()
        else:
            plain = _PLAIN.match(text)
        if not plain or "<|" in text:
            return self._encode(text)
        return b"".join(map(self._run, _RUNS.findall(text.lower())))

    def _run(self, run: str) -> bytes:
        """Ids of what the pre-tokenizer gives the model, here without the library's other steps."""
        if (ids := self.runs.get(run)) is None:
            seen = run if run.isascii() else run.encode().decode("latin-1").translate(_SHOWN)
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(seen)]).tobytes()
            self.runs.put(run, ids)
        return ids

    def text(self, text: bytes) -> bytes:
        """Ids of a whole text."""
        words = text.split()
        ids = list(map(self.words.young.get, words))
        if None in ids:
            for k, found in enumerate(ids):
                if found is None:
                    ids[k] = self.word(words[k])
        return b"".join(ids)


#: Bytes of text for which a bucket is made.
BUCKET_TEXT = 64 << 20

_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder a process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _forget() -> None:
    _encoders.clear()
    load_tokenizer.cache_clear()
    pieces_by_id.cache_clear()


KEPT.append(_forget)

_WORDS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("check", pa.int64()), ("words", pa.binary()), ("numbers", pa.binary())])


def _block_words(table: pa.Table, text: str) -> tuple[list[bytes], list[bytes], int]:
    """Texts, sorted distinct words and a checksum of a block."""
    texts = text_bytes(table.column(text))
    found: set[bytes] = set()
    check = 0
    for t in texts:
        found.update(t.split())
        check = zlib.crc32(t, check)
    return texts, sorted(found), check


def _list_words(text: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor().compress
        for block, table in task_blocks(batches, text):
            _, words, check = _block_words(table, text)
            del table
            by = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
            order = np.argsort(by, kind="stable")
            edges = np.searchsorted(by[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                own = order[edges[b] : edges[b + 1]]
                row = {"bucket": b, "block": block, "check": check, "words": pack(b"\n".join([words[i] for i in own])), "numbers": pack(np.diff(own, prepend=0).astype("<u4").tobytes())}
                yield pa.RecordBatch.from_pylist([row], schema=_WORDS)

    return run


#: What Spark's bitmaps hold.
PAGE = 1 << 15
_BITS = pa.list_(pa.struct([("page", pa.int32()), ("bits", pa.binary())]))
_ANSWERS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("check", pa.int64()), ("payload", pa.binary()), ("used", _BITS)])
_ANSWERS_DDL = "block long, kind int, check long, payload binary, used array<struct<page:int,bits:binary>>"
#: Kinds of rows at a block, in the order in which it reads them.
_IDS, _PIECES, _TEXTS = 0, 1, 2


def _bitmaps(ids: np.ndarray) -> list[dict]:
    """Bits of the ids, a bitmap for each page that has any."""
    out = []
    for page in np.unique(ids >> 15).tolist():
        bits = np.zeros(PAGE, bool)
        bits[ids[ids >> 15 == page] & PAGE - 1] = True
        out.append({"page": page, "bits": np.packbits(bits, bitorder="little").tobytes()})
    return out


def _encode_words(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; each distinct word of a bucket is encoded once."""
        pack, unpack = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
        encoder = WordEncoder(path)
        bucket, table = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, table = row["bucket"], {}
                ids = []
                for w in unpack(row["words"]).split(b"\n"):
                    if (x := table.get(w)) is None:
                        x = table[w] = encoder.fresh(w)
                    ids.append(x)
                counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                flat = b"".join(ids)
                payload = pack(np.array([len(ids)], "<u4").tobytes() + unpack(row["numbers"]) + counts.astype("<u4").tobytes() + flat)
                answer = {"block": row["block"], "kind": _IDS, "check": row["check"], "payload": payload, "used": _bitmaps(np.unique(np.frombuffer(flat, "<u4").astype(np.int64)))}
                yield pa.RecordBatch.from_pylist([answer], schema=_ANSWERS)

    return run


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each id of a block's bitmaps."""
    for batch in batches:
        for block, page, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")) + page * PAGE
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block, np.int64)), pa.array(ids.astype(np.int32))], names=["block", "id"])


def block_pieces(answers: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The pieces of each block's distinct ids by a join of (id, piece): block, ids, pieces.

    Both sides of the join, and each group, are bounded by the vocabulary.
    """
    pages = answers.select("block", F.explode("used").alias("u")).groupBy("block", F.col("u.page").alias("page")).agg(F.bitmap_or_agg("u.bits").alias("bits"))
    joined = pages.mapInArrow(_set_bits, "block long, id int").join(F.broadcast(vocabulary), "id")
    both = joined.groupBy("block").agg(F.collect_list(F.struct("id", "piece")).alias("x"))
    return both.select("block", F.col("x.id").alias("ids"), F.col("x.piece").alias("pieces"))


def vocabulary_table(spark, path: str) -> DataFrame:
    """id, piece of a tokenizer; ids without a piece are left out."""
    return spark.createDataFrame([(i, p.decode()) for i, p in enumerate(pieces_by_id(path)) if p], "id int, piece string")


def _ship_blocks(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table in task_blocks(batches, text):
            check = 0
            for t in text_bytes(table.column(text)):
                check = zlib.crc32(t, check)
            yield pa.RecordBatch.from_pylist([{"block": block, "kind": _TEXTS, "check": check, "payload": to_ipc(table), "used": []}], schema=_ANSWERS)

    return run


def _word_ids(answers: list[tuple[int, bytes]], n_words: int, check: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block's words one after the other by word number, and where each word's ids begin."""
    counts = np.zeros(n_words, np.int64)
    parts = []
    for seen, payload in answers:
        if seen != check:
            raise RuntimeError("the table changed between two scans")
        n = int(np.frombuffer(payload, "<u4", 1)[0])
        own = np.cumsum(np.frombuffer(payload, "<u4", n, 4).astype(np.int64))
        counts[own] = np.frombuffer(payload, "<u4", n, 4 + 4 * n)
        parts.append((own, np.frombuffer(payload, "<u4", -1, 4 + 8 * n)))
    starts = np.concatenate(([0], np.cumsum(counts)))
    flat = np.zeros(int(starts[-1]), np.uint32)
    for own, ids in parts:
        n = counts[own]
        flat[np.repeat(starts[own] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))] = ids
    return flat, starts


def _joined(parts: list[bytes], starts: list[int]) -> list[bytes]:
    """What each word's ids come to, joined by blanks."""
    return [parts[a] if b - a == 1 else b" ".join(parts[a:b]) for a, b in zip(starts, starts[1:], strict=False)]


def _join_back(text: str, id_column: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block: the answers of a block, its pieces, its texts."""
        unpack = zstandard.ZstdDecompressor().decompress
        block, answers, pieces = None, [], {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block:
                    block, answers, pieces = row["block"], [], {}
                if row["kind"] == _IDS:
                    answers.append((row["check"], unpack(row["payload"])))
                    continue
                if row["kind"] == _PIECES:
                    pieces = {i: p.encode() for i, p in zip(row["ids"], row["pieces"], strict=True)}
                    continue
                table = from_ipc(row["payload"])
                texts, words, check = _block_words(table, text)
                flat, starts = _word_ids(answers, len(words), check)
                at, ids = starts.tolist(), flat.tolist()
                digits = _joined([b"%d" % i for i in ids], at)
                decoded = _joined([pieces[i] for i in ids], at)
                counts = np.diff(starts)
                # Words without ids have no number, so that nothing is joined for them.
                number = {w: k for k, w in enumerate(words) if at[k] < at[k + 1]}
                del words, answers
                whole = len(number) == len(counts)
                out = {"row_id": table.column(id_column).to_pylist(), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
                for t in texts:
                    own = [number[w] for w in t.split()] if whole else [k for w in t.split() if (k := number.get(w)) is not None]
                    out["n_tokens"].append(int(counts[own].sum()) if own else 0)
                    out["ids_sha256"].append(hashlib.sha256(b" ".join([digits[k] for k in own])).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(b" ".join([decoded[k] for k in own])).hexdigest())
                    out["ids"].append([i for k in own for i in ids[at[k] : at[k + 1]]] if with_ids else None)
                yield pa.RecordBatch.from_arrays([pa.array(out["row_id"], pa.int64()), pa.array(out["n_tokens"], pa.int64()), pa.array(out["ids_sha256"], pa.string()), pa.array(out["decoded_sha256"], pa.string()), pa.array(out["ids"], pa.list_(pa.int32()))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])
                answers = []

    return run


def encode_documents(docs: DataFrame, path: str, text: str = "text", id_column: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Encode and decode every text of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, ids (null unless ``with_ids``).

    ``docs`` must be a table as read (projected or filtered at most), for it
    is read three times, once for its size; a checksum of each block guards against changes between.
    The result is a table in the shared folder.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias(id_column), text)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(shuffle_partitions(spark), -(-size // BUCKET_TEXT))
    no_pieces = {"ids": F.lit(None).cast("array<int>"), "pieces": F.lit(None).cast("array<string>")}
    with repeatable_scans(spark):
        words = docs.mapInArrow(_list_words(text, parts), "bucket int, block long, check long, words binary, numbers binary")
        answers = materialize(words.repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(_encode_words(path), _ANSWERS_DDL), "bpe-words")
        blocks = docs.mapInArrow(_ship_blocks(text), _ANSWERS_DDL)
        pieces = block_pieces(answers, vocabulary_table(spark, path)).select("block", F.lit(_PIECES).alias("kind"), F.lit(0).cast("long").alias("check"), F.lit(None).cast("binary").alias("payload"), "ids", "pieces")
        # Blocks come first in the union: their ids are made from the task's place in the scan.
        joined = blocks.unionByName(answers).drop("used").withColumns(no_pieces).unionByName(pieces)
        met = joined.repartition(parts, "block").sortWithinPartitions("block", "kind")
        out = materialize(met.mapInArrow(_join_back(text, id_column, with_ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>"), "bpe-documents")
        drop(answers)
    return out


def decode_ids(rows: DataFrame, vocabulary: DataFrame, id_column: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Ids back to text by a join of (id, piece): id_column, decoded.

    ``vocabulary`` has id and piece and is bounded by the tokenizer's size, so
    it is broadcast. Rows without ids (null or empty) decode to an empty text;
    ids that the vocabulary lacks are skipped. Repeated rows give a row each.
    """
    keyed = rows.select(F.monotonically_increasing_id().alias("_row"), F.col(id_column), F.col(ids).alias("_ids"))
    long = keyed.select("_row", F.col(id_column), F.posexplode_outer("_ids").alias("_at", "_id"))
    hit = long.join(F.broadcast(vocabulary.select(F.col("id").alias("_id"), F.col("piece").alias("_piece"))), "_id", "left")
    pieces = F.transform(F.array_sort(F.collect_list(F.when(F.col("_piece").isNotNull(), F.struct("_at", "_piece")))), lambda x: x["_piece"])
    return hit.groupBy("_row", F.col(id_column)).agg(F.array_join(pieces, " ").alias("decoded")).drop("_row")
