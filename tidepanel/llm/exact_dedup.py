"""Exact dedup by a content sort.

1. Sampled splitters range-partition the rows. Their keys are bounded: the first
   bytes of the text, a hash of the whole text and the id, so the sample on the
   driver stays small however long texts are, and a text that a third of all
   rows share is dealt over as many partitions as its rows need.
2. Each partition is sorted by the same key and the whole text (Spark's external
   sort, which spills). Equal texts are neighbours then.
3. Neighbours are compared in full. A run of equal texts gets its size and its
   best id; rows leave without their texts. A task holds its partition's ids and
   digests (in ``keep_one`` the rows that lead a run), and a partition is made
   for each 64 MB of text and for each half million rows.
4. Runs that may go on in another partition are those with a partition's first
   or last hash. They are grouped by their full text, two or so for each
   partition, and the totals go back to their rows in a table of as many rows,
   which is broadcast.

The hash only orders: texts that share one are told apart by comparison.

Null text counts as empty. A null id ranks below every id, so such a row stays
only in a group without any id, and ``keep_id`` is null there. Of repeated rows
(one id, one text) one stays; which, does not show. Texts of any length are
compared whole. Empty tables give empty results. Extra columns, whatever their
names, pass through ``keep_one`` and are ignored by ``exact_duplicates``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from .blocks import tidy
from .tables import materialize, shuffle_partitions

#: Leading bytes of a text in the splitters.
HEAD_BYTES = 16
#: Bytes of text for which a partition is made.
PART_TEXT = 64 << 20
#: Rows for which a partition is made.
PART_ROWS = 500_000


def _marks(leads_only: bool, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows (text, hash, id, others) to id, others and what is known of their run."""
        from pyspark import TaskContext

        ids, kept, starts, total, runs = [], [], [], 0, 0
        text = first = last = None
        edges: dict[int, bytes] = {}
        newest: dict[int, bytes] = {}
        for batch in batches:
            texts, hashes, n = batch.column(0), batch.column(1).to_numpy(), batch.num_rows
            if not n:
                continue
            new = np.ones(n, bool)
            new[1:] = ~pc.equal(texts.slice(1), texts.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = text is None or texts[0].as_py() != text
            text = texts[n - 1].as_py()
            at = np.flatnonzero(new)
            first = hashes[0] if first is None else first
            if last != hashes[-1]:
                last, newest = hashes[-1], {}
            for wanted, into in ((first, edges), (last, newest)):
                for k in np.flatnonzero(hashes[at] == wanted).tolist():
                    into[runs + k] = texts[int(at[k])].as_py()
            ids.append(batch.column(2))
            others = batch.select(range(3, batch.num_columns))
            kept.append(others.take(pa.array(at)) if leads_only else others)
            starts.append(at + total)
            total, runs = total + n, runs + len(at)
        if not total:
            return
        edges |= newest
        lead = np.concatenate(starts)
        size = np.diff(lead, append=total)
        number, of = np.full(runs, -1), np.full(runs, None, object)
        number[list(edges)] = [(TaskContext.get().partitionId() << 32) + k for k in edges]
        for k, t in edges.items():
            of[k] = t
        every = pa.chunked_array(ids).combine_chunks()
        every = every.chunk(0) if isinstance(every, pa.ChunkedArray) else every
        best = every.take(pa.array(lead))
        table = pa.Table.from_batches(kept)
        if leads_only:
            mine, leads, texts = every.take(pa.array(lead)), np.ones(runs, bool), pa.array(of, pa.binary())
        else:
            of_row = np.repeat(np.arange(runs), size)
            leads = np.zeros(total, bool)
            leads[lead] = True
            full = np.full(total, None, object)
            full[lead] = of
            mine, best, texts = every, best.take(pa.array(of_row)), pa.array(full, pa.binary())
            number, size = number[of_row], size[of_row]
        marks = [best, pa.array(size), pa.array(leads), pa.array(number, mask=number < 0), texts]
        whole = pa.Table.from_arrays([mine, *table.columns, *marks], schema=out)
        yield from whole.to_batches(max_chunksize=10_000)

    return tidy(run)


def _sorted_runs(docs: DataFrame, text: str, id_column: str, largest: bool, normalise: Callable[[Column], Column] | None, others: list[Column], leads_only: bool) -> DataFrame:
    """``_id``, the other columns, and of each row's run: ``_best`` id, size ``_n``, whether the row leads it (once in all partitions)."""
    spark = docs.sparkSession
    whole = F.coalesce(normalise(F.col(text)) if normalise else F.col(text), F.lit("")).cast("string").cast("binary")
    rows = docs.select(whole.alias("_text"), F.col(id_column).alias("_id"), *others).withColumn("_hash", F.xxhash64("_text")).withColumn("_head", F.substring("_text", 1, HEAD_BYTES))
    size, count = docs.agg(F.sum(F.octet_length(text)), F.count("*")).first()
    parts = max(shuffle_partitions(spark), -(-(size or 0) // PART_TEXT), -(-count // PART_ROWS))
    by_id = F.col("_id").desc_nulls_last() if largest else F.col("_id").asc_nulls_last()
    dealt = rows.repartitionByRange(parts, F.col("_head"), F.col("_hash"), by_id).sortWithinPartitions("_head", "_hash", "_text", by_id)
    names = [c for c in rows.columns if c not in ("_text", "_id", "_hash", "_head")]
    sent = dealt.select("_text", "_hash", "_id", *((F.sha2("_text", 256).alias("_sha"),) if not leads_only else ()), *names)
    kinds = {f.name: f for f in sent.schema.fields}
    fields = [kinds[c] for c in sent.columns[2:]]
    fields += [StructField("_best", kinds["_id"].dataType), StructField("_n", LongType()), StructField("_lead", BooleanType()), StructField("_edge", LongType()), StructField("_of", BinaryType())]
    schema = StructType([StructField(f.name, f.dataType, True) for f in fields])
    arrow = to_arrow_schema(schema)
    marked = materialize(sent.mapInArrow(_marks(leads_only, arrow), schema), "content-sort")
    edges = marked.where("_of is not null").select("_of", "_edge", "_best", "_n")
    best = F.max("_best") if largest else F.min("_best")
    totals = edges.groupBy("_of").agg(best.alias("_best_all"), F.sum("_n").alias("_n_all"), F.min("_edge").alias("_first"))
    back = edges.select("_of", "_edge").join(totals, "_of").drop("_of")
    known = marked.drop("_of").join(F.broadcast(back), "_edge", "left")
    over = F.col("_first").isNotNull()
    return known.select(
        *sent.columns[2:],
        F.when(over, F.col("_best_all")).otherwise(F.col("_best")).alias("_best"),
        F.when(over, F.col("_n_all")).otherwise(F.col("_n")).alias("_n"),
        (F.col("_lead") & (~over | (F.col("_first") == F.col("_edge")))).alias("_lead"),
    )


def exact_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", largest: bool = False, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    ``normalise`` maps the text column before texts are compared. Of equal texts
    the row with the smallest id stays, or the ``largest``.
    """
    found = _sorted_runs(docs, text, id_column, largest, normalise, [], False)
    return found.select(F.col("_id").alias("doc_id"), F.col("_best").alias("keep_id"), F.col("_n").alias("group_size"), F.col("_lead").alias("kept"), F.col("_sha").alias("text_sha256"))


def keep_one(docs: DataFrame, text: str = "text", id_column: str = "doc_id", largest: bool = False, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns as they are."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    carried = [F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)]
    found = _sorted_runs(docs, text, id_column, largest, normalise, carried, True).where("_lead")
    return found.select(*(F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)))
