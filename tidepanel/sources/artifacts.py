"""Files and artifacts at any URI that the cluster's file systems know.

Text files are written beside their place and renamed into it. An artifact is a
folder that is written under a name of its own, listed in a manifest with sizes
and checksums (made by a job over its files), renamed to its version, and made
current by a small pointer file that a rename replaces. A reader follows the
pointer, so it sees the version before or the version after, never a half of
one; ``verify`` compares files with the manifest.

Paths are strings. ``pathlib`` would take a slash from ``s3a://bucket``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest.json"
POINTER = "current.json"


def joined(root, *names: str) -> str:
    """A path below a root, which may be a URI."""
    return "/".join([str(root).rstrip("/") or "/", *names]) if str(root) != "/" else "/" + "/".join(names)


class Files:
    """The few operations on files that artifacts need, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        at = self._hadoop.Path(path)
        return at.getFileSystem(self._conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def make_folder(self, path: str) -> None:
        fs, at = self._at(path)
        fs.mkdirs(at)

    def names(self, path: str) -> list[str]:
        fs, at = self._at(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def read_text(self, path: str) -> str:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Replace a file; readers see the old text or the new one."""
        staged = f"{path}.{uuid.uuid4().hex}"
        fs, at = self._at(staged)
        stream = fs.create(at, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        self.replace(staged, path)

    def rename(self, source: str, target: str) -> None:
        fs, at = self._at(source)
        if not fs.rename(at, self._hadoop.Path(target)):
            raise OSError(f"Could not rename {source} to {target}")

    def replace(self, source: str, target: str) -> None:
        """Rename over what is there."""
        _, at = self._at(source)
        kind = getattr(self._hadoop, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        fs, to = self._at(target)
        context = self._hadoop.FileContext.getFileContext(fs.getUri(), self._conf)
        context.rename(fs.makeQualified(at), fs.makeQualified(to), options)


def _listing(spark: SparkSession, folder: str) -> dict[str, dict]:
    """Size and SHA-256 of the files below a folder, by their place in it."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    rows = read.select("path", "length", F.sha2("content", 256).alias("sha256")).collect()
    mark = "/" + folder.rstrip("/").rsplit("/", 1)[-1] + "/"
    return {r["path"].split(mark, 1)[1]: {"length": r["length"], "sha256": r["sha256"]} for r in rows if not r["path"].endswith(f"/{MANIFEST}")}


def publish(spark: SparkSession, root: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Have ``write`` fill a folder, and make it the current version of the artifact at ``root``; its path.

    Nothing is current before all is written. The ``keep`` last versions stay
    for readers that have begun; what a failed write left is deleted.
    """
    files = Files(spark)
    version = uuid.uuid4().hex
    staged = joined(root, f"staged-{version}")
    files.make_folder(root)
    try:
        write(staged)
        files.write_text(joined(staged, MANIFEST), json.dumps(_listing(spark, staged), indent=1, sort_keys=True))
        target = joined(root, f"version-{version}")
        files.rename(staged, target)
    except BaseException:
        files.delete(staged)
        raise
    before = json.loads(files.read_text(joined(root, POINTER)))["versions"] if files.exists(joined(root, POINTER)) else []
    versions = [f"version-{version}", *before]
    files.write_text(joined(root, POINTER), json.dumps({"versions": versions[:keep]}))
    for old in versions[keep:]:
        files.delete(joined(root, old))
    return target


def current(spark: SparkSession, root: str) -> str:
    """The folder of the current version."""
    files = Files(spark)
    if not files.exists(joined(root, POINTER)):
        raise FileNotFoundError(f"No published artifact at {root}")
    return joined(root, json.loads(files.read_text(joined(root, POINTER)))["versions"][0])


def verify(spark: SparkSession, folder: str) -> None:
    """Compare the files of a version with its manifest."""
    listed = json.loads(Files(spark).read_text(joined(folder, MANIFEST)))
    found = _listing(spark, folder)
    if listed != found:
        odd = sorted(k for k in {*listed, *found} if listed.get(k) != found.get(k))
        raise ValueError(f"Files differ from the manifest of {folder}: {odd[:10]}")
