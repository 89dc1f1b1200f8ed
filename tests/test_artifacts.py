import json

import pytest

from tidepanel.sources import artifacts as A


def parts(spark, folder, value):
    spark.range(value, value + 10).repartition(3).write.parquet(A.joined(folder, "rows"))
    A.Files(spark).write_text(A.joined(folder, "note.json"), json.dumps(value))


def seen(spark, root):
    folder = A.current(spark, root)
    A.verify(spark, folder)
    return json.loads(A.Files(spark).read_text(A.joined(folder, "note.json"))), spark.read.parquet(A.joined(folder, "rows")).agg({"id": "min"}).first()[0]


def test_uris_stay_whole():
    assert A.joined("s3a://bucket/x/", "a", "b") == "s3a://bucket/x/a/b" and A.joined("hdfs://node:8020", "d") == "hdfs://node:8020/d" and A.joined("/", "tmp") == "/tmp"


@pytest.mark.parametrize("scheme", ["", "file://", "file:"])
def test_versions_follow_one_another(spark, tmp_path, scheme):
    root = f"{scheme}{tmp_path}/store"
    for k in (1, 2, 3):
        A.publish(spark, root, lambda folder, k=k: parts(spark, folder, k))
        assert seen(spark, root) == (k, k)
    assert sum(n.startswith("version-") for n in A.Files(spark).names(root)) == 2


def test_an_interrupted_write_changes_nothing(spark, tmp_path):
    """Readers keep what was current, while and after a write breaks off; nothing is left of it."""
    root = f"file://{tmp_path}/store"
    with pytest.raises(FileNotFoundError):
        A.current(spark, root)
    A.publish(spark, root, lambda folder: parts(spark, folder, 1))
    before = A.Files(spark).names(root)

    def breaks(folder):
        parts(spark, folder, 2)
        assert seen(spark, root) == (1, 1)
        raise RuntimeError("lost power")

    with pytest.raises(RuntimeError, match="lost power"):
        A.publish(spark, root, breaks)
    assert seen(spark, root) == (1, 1) and [n for n in A.Files(spark).names(root) if not n.startswith(".")] == [n for n in before if not n.startswith(".")]


def test_changed_files_are_noticed(spark, tmp_path):
    folder = A.publish(spark, str(tmp_path / "store"), lambda f: parts(spark, f, 5))
    A.Files(spark).write_text(A.joined(folder, "note.json"), "6")
    with pytest.raises(ValueError, match="note.json"):
        A.verify(spark, folder)
