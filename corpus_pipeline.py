"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before kept. All but the last return the columns of ``documents``, whatever
further columns a table has and whatever their names; these pass through. All
stages take null in any column, read texts of any length whole, and give an
empty result for an empty table. Each says what it does with null and empty
texts, repeated rows and ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import language_id, packing, quality, simhash, substring_dedup
from tidepanel.llm.queries import remainder, vocabulary_path
from tidepanel.llm.tables import drop, materialize, read, unused

#: Documents below are rejected. A language score of one quarter says nothing among four languages.
MIN_QUALITY = 0.5
MIN_LANGUAGE = 0.3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose quality score is at least ``MIN_QUALITY``.

    Null and empty texts are one empty passage and scored like any other.
    Repeated rows have one score and go or stay together. Where there are no
    labels every score is one half, and all rows stay. A null id teaches
    nothing.
    """
    model = quality.learn(docs.where(remainder(3) != 1), read(spark, sf_dir, "labels", "doc_id", "quality"))
    (score,) = unused(docs.columns, "score")
    return quality.score(docs, model, docs.columns, out=score).where(F.col(score) >= MIN_QUALITY).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language can be told.

    Null texts and texts without a letter go. Repeated rows go or stay
    together. Where nothing is there to learn from no language can be told, so
    all rows go. Ties between languages change which one is told, never whether.
    """
    model = language_id.learn(docs.where(remainder(4) != 2))
    found, score = unused(docs.columns, "lang_pred", "score")
    known = (F.col(found) != language_id.UNDETERMINED) & (F.col(score) >= MIN_LANGUAGE)
    return language_id.predict(docs, model, docs.columns, out=(found, score)).where(known).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that of the smallest id.

    Null and empty texts are near duplicates of one another. Of repeated rows
    of the smallest id one stays, the lowest by a hash of its text. A row
    without an id stays only in a group without any id.
    """
    return simhash.keep_one(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages out that documents with smaller ids have; n_chars follows the text.

    Null and empty texts stay as they are (n_chars is null for a null text), and
    no row goes. Rows of one id take nothing from one another; a null id counts
    as larger than any other.
    """
    out = substring_dedup.remove(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token pieces of all documents into sequences.

    Null and empty texts are one end token. Repeated rows are packed each; rows
    of one length may change places.
    """
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring),
    ("best-fit packing", best_fit_packing),
]

#: The stages learn models and tokenize, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
