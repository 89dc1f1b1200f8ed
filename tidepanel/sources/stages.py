"""Results of stages in a store, found again by what they depend on.

Every result has a key: a hash of the stage's name and function, its parameters
and the keys of its inputs; of a table also its logical plan. A source's key
comes from its files (path, length, time of change). A result is kept in the
folder ``root/name/key``, so a stage whose key is there is read and not made,
and a changed file, parameter or plan gives a new key to all that follows from
it and to nothing else.

A folder is written beside its place, renamed into it, and only then gets the
note that says it is whole. A run that is stopped leaves folders without a note,
which are made anew. Two runs that make one result at once leave one of them.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .artifacts import Files, joined

NOTE, DATA = "stage.json", "data"
_FIELDS = "spark.sql.debug.maxToStringFields"


def hashed(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()


def files_key(spark: SparkSession, path: str) -> str:
    """A key of the files below a path. They are listed and summed up by Spark and not opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.unix_micros("modificationTime").alias("changed"))
    own = lambda k: F.bit_xor(F.xxhash64(F.lit(k), "path", "length", "changed"))
    return hashed(list(listed.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), own(1), own(2)).first()))


def plan_text(frame: DataFrame) -> str:
    """The logical plan without the numbers that Spark gives to columns anew in each session."""
    conf = frame.sparkSession.conf
    before = conf.get(_FIELDS)
    conf.set(_FIELDS, "100000")
    try:
        text = frame._jdf.queryExecution().analyzed().canonicalized().toString()
    finally:
        conf.set(_FIELDS, before)
    return re.sub(r"\b([a-z]+)_\d+#", r"\1#", re.sub(r"#\d+L?", "#", text))


@dataclass(frozen=True)
class Kept:
    """A result: its key, what it is (a frame, JSON values or a model), and whether it was there already."""

    key: str
    value: Any
    reused: bool = True


class Stages:
    """A store of results at a folder or URI that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, str(root), Files(spark)

    def source(self, path: str, format: str = "parquet", **options) -> Kept:
        """Files as they are: the start of a chain. Their key is taken now."""
        return Kept(hashed("source", format, options, files_key(self.spark, path)), self.spark.read.format(format).options(**options).load(path))

    def table(self, name: str, make: Callable[..., DataFrame], *inputs: Kept, **params) -> Kept:
        """``make(*values of inputs, **params)`` must be lazy, for it is called for its plan even where the result is there,
        and read nothing but its inputs.

        A frame that rests on rows of the driver, on random numbers or on Python
        functions is refused: its plan does not say what it holds.
        """
        frame = make(*(x.value for x in inputs), **params)
        plan = plan_text(frame)
        if found := re.search(r"\b(LogicalRDD|ExternalRDD|LocalRelation|InMemoryRelation)\b|\b(?:rand|randn|uuid|shuffle)\(|PythonUDF|MapInPandas|FlatMap\w*InPandas|MapInArrow", plan):
            raise ValueError(f"The plan of stage {name!r} does not say what it holds: {found[0]}")
        return self._kept(name, self._key(name, make, inputs, params, plan), lambda: frame, lambda x, at: x.write.parquet(at), self.spark.read.parquet)

    def values(self, name: str, make: Callable[..., Any], *inputs: Kept, **params) -> Kept:
        """Small results as JSON: figures, or rows of a summary as a list. ``make`` is called only where they are missing."""
        write = lambda x, at: self.files.write_text(at, json.dumps(x, default=str))
        return self._kept(name, self._key(name, make, inputs, params), lambda: make(*(x.value for x in inputs), **params), write, lambda at: json.loads(self.files.read_text(at)))

    def model(self, name: str, make: Callable[..., PipelineModel], *inputs: Kept, **params) -> Kept:
        """A fitted pipeline. ``make`` is called only where it is missing."""
        return self._kept(name, self._key(name, make, inputs, params), lambda: make(*(x.value for x in inputs), **params), lambda x, at: x.write().save(at), PipelineModel.load)

    @staticmethod
    def _key(name: str, make, inputs, params, plan: str = "") -> str:
        """The function counts with its own text; what it calls does not, so a stage of eager functions takes a version as a parameter."""
        try:
            text = inspect.getsource(make)
        except (OSError, TypeError):
            text = getattr(make, "__qualname__", repr(make))
        return hashed(name, text, params, [x.key for x in inputs], plan)

    def _kept(self, name: str, key: str, make, write, read) -> Kept:
        folder = joined(self.root, name, key)
        if self.files.exists(joined(folder, NOTE)):
            return Kept(key, read(joined(folder, DATA)))
        staged = joined(self.root, name, f"staged-{uuid.uuid4().hex}")
        try:
            self.files.make_folder(staged)
            write(make(), joined(staged, DATA))
            if self.files.exists(folder) and not self.files.exists(joined(folder, NOTE)):
                # What a stopped run left.
                self.files.delete(folder)
            if not self.files.exists(folder):
                self.files.rename(staged, folder)
                self.files.write_text(joined(folder, NOTE), json.dumps({"name": name, "key": key}))
        finally:
            self.files.delete(staged)
        return Kept(key, read(joined(folder, DATA)), reused=False)

    def keys(self, name: str) -> list[str]:
        """Keys of the whole results of a stage."""
        return [k for k in self.files.names(joined(self.root, name)) if self.files.exists(joined(self.root, name, k, NOTE))]

    def keep_only(self, name: str, *results: Kept) -> None:
        """Delete the other results of a stage; no run may be using them."""
        for k in self.files.names(joined(self.root, name)):
            if k not in {x.key for x in results}:
                self.files.delete(joined(self.root, name, k))
