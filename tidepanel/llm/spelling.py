"""Spelling variants of a vocabulary, grouped under their frequent forms, by anagram hashing.

1. Runs of letters are counted (summed up before the shuffle) and words with too
   few letters or occurrences go.
2. A word's key is the sum of the fifth powers of its code points (modulo
   2^61 - 1), so anagrams share it. Taking a letter's value away gives the key of
   a word with a hole. Two words of which one has a letter more meet where the
   longer one's hole key is the other's key; words that exchange one letter for
   another meet in a hole key of both: the keys differ by one removal, addition
   or exchange value.
3. Keys alone would bring all anagrams together. Half of the letters around a
   hole must be in place whatever the edit is, so each key is joined twice, with
   a hash of the half before and of the half behind; a pair with equal fronts
   counts in the first join only. Letter order is then verified by the edit
   distance.
4. Each word's near words are counted and the most frequent one becomes its form,
   if it is frequent enough; chains of forms are followed to their ends by
   pointer doubling. The ratio of counts bounds the number of rounds.

A key meets as many words as share half their letters in place, all their
letters but one, and the length; nothing is grouped in one task and every join
is one that Spark may split.

Null texts have no words, a null id counts as an empty one. Texts are read
whole. Repeated rows count each. Ties go to the smaller word in code-point
order. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import drop, materialize

#: Letters: A-Z, a-z and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
_MODULUS = (1 << 61) - 1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, text: str = "text", id_column: str = "doc_id", change: Callable[[Column, Column], Column] | None = None
) -> DataFrame:
    """word, n: the runs of letters, lower-cased within A-Z, with their occurrences.

    ``change`` maps (id as text, run) to the word that counts; it may only
    shorten runs.
    """
    lowered = F.translate(F.col(text), _UPPER, _LOWER)
    runs = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(lowered, F.lit(f"([{LETTERS}]+)"), F.lit(1))).alias("_run"))
    long = runs.where(F.char_length("_run") >= min_length)
    words = long.select((change(F.col("_id"), F.col("_run")) if change else F.col("_run")).alias("word"))
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _value(letter: Column) -> Column:
    """The fifth power of a code point: no two pairs of values have one difference."""
    x = F.ascii(letter).cast("decimal(7,0)")
    return (x * x * x * x * x % F.lit(_MODULUS)).cast("long")


def anagram_key(letters: Column) -> Column:
    return F.aggregate(letters, F.lit(0).cast("long"), lambda total, c: (total + _value(c)) % _MODULUS)


def _meeting_places(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words with a hole, and whole words, by size without the hole, key, and side of the equal half."""
    keyed = words.withColumn("_letters", F.regexp_extract_all("word", F.lit("(?s)(.)"), F.lit(1))).withColumn("_key", anagram_key(F.col("_letters"))).withColumn("_size", F.char_length("word"))
    holes = keyed.select("word", "n", (F.col("_size") - 1).alias("size"), "_key", F.explode(F.array_distinct("_letters")).alias("_hole"))
    holes = holes.select("word", "n", "size", F.pmod(F.col("_key") - _value(F.col("_hole")), F.lit(_MODULUS)).alias("key"), F.lit(1).alias("hole"))
    whole = keyed.select("word", "n", F.col("_size").alias("size"), F.col("_key").alias("key"), F.lit(0).alias("hole"))

    def sides(df: DataFrame) -> DataFrame:
        front = F.expr("substring(word, 1, size div 2)")
        behind = F.expr("substring(word, size div 2 + 1 + hole, size + 1)")
        return df.select("*", front.alias("front"), F.posexplode(F.array(F.xxhash64(front), F.xxhash64(behind))).alias("side", "half"))

    return sides(holes), sides(whole)


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n for words of ``words`` (word, n; each once) one letter apart, either way."""
    holes, whole = _meeting_places(words)
    right = holes.unionByName(whole)
    right = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    meet = [F.col(c) == F.col(f"r_{c}") for c in ("key", "size", "side", "half")]
    met = holes.join(right.hint("merge"), meet)
    once = (F.col("r_hole") == 0) | (F.col("word") < F.col("r_word"))
    in_place = F.when(F.col("side") == 0, F.col("front") == F.col("r_front")).otherwise(F.col("front") != F.col("r_front"))
    near = met.where(once & in_place & (F.levenshtein("word", "r_word", 1) == 1))
    ways = F.array(F.struct("word", "n", F.col("r_word").alias("other"), F.col("r_n").alias("other_n")), F.struct(F.col("r_word").alias("word"), F.col("r_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return near.select(F.inline(ways))


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n).

    A word's form is its most frequent near word, if that is at least ``ratio``
    times as frequent (more than once, so that forms end). Its root is the last
    of its forms, or the word.
    """
    if ratio <= 1:
        raise ValueError("ratio must exceed 1")
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")), "words")
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best"))
    near = materialize(best, "near-words")
    known = words.join(near.hint("merge"), "word", "left")
    has_form = -F.col("best.less") >= ratio * F.col("n")
    formed = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best.other")).alias("form"), F.when(has_form, -F.col("best.less")).alias("form_n"))
    formed = materialize(formed, "forms")
    drop(near)
    low, high = words.agg(F.min("n"), F.max("n")).first()
    ends = formed.where("form is not null").select("word", F.col("form").alias("root"))
    steps = math.floor(math.log(high / low, ratio) + 1e-9) if high else 0
    for _ in range(max(0, math.ceil(math.log2(steps)) if steps > 1 else 0)):
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        after = materialize(ends.join(further.hint("merge"), "root", "left").select("word", F.coalesce("_further", "root").alias("root")), "roots")
        drop(ends)
        ends = after
    out = formed.join(ends.hint("merge"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
