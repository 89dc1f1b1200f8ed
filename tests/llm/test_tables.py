from pathlib import Path
from types import SimpleNamespace

import pytest

from tidepanel.llm import tables


def test_materialize_and_clean(spark):
    folder = Path(tables.shared_dir(spark))
    kept = tables.materialize(spark.range(5).toDF("x"), "kept")
    gone = tables.materialize(spark.range(5).toDF("x"), "gone")
    tables.drop(gone)
    assert kept.count() == 5 and not list(folder.glob("gone-*"))
    tables.clean(spark)
    assert not list(folder.glob("kept-*"))


def test_shared_dir_comes_from_the_session(spark):
    assert tables.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


@pytest.mark.parametrize(("master", "fails"), [("local[2]", False), ("spark://host:7077", True), ("yarn", True)])
def test_a_cluster_needs_a_shared_folder(master, fails):
    class Conf(dict):
        set = dict.__setitem__

    session = SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(master=master))
    if fails:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            tables.shared_dir(session)
    else:
        assert tables.shared_dir(session) == session.conf["spark.checkpoint.dir"]


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with tables.settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_workers_forget_what_other_operators_left():
    from tidepanel.llm import blocks, bpe
    from tidepanel.llm.queries import vocabulary_path

    bpe.word_encoder(vocabulary_path()).text(b"a word")
    assert list(blocks.tidy(lambda batches: batches)(iter([1, 2]))) == [1, 2] and not bpe._encoders
    assert bpe.load_tokenizer.cache_info().currsize == 0
