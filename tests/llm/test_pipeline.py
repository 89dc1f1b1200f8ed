import pytest

import corpus_pipeline
from tidepanel.llm.tables import materialize, read

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, SMALL), "test-stage")
        out.append((name, docs, after))
        docs = after
    return out


def test_columns_and_order(spark, stages):
    columns = read(spark, SMALL, "documents").columns
    assert [n for n, _, _ in stages] == ["quality classifier", "language ID", "SimHash near-dedup", "substring dedup", "best-fit packing"]
    assert all(after.columns == columns for _, _, after in stages[:-1])


def test_quality_keeps_good_and_drops_bad(spark, stages):
    kept = {r[0] for r in stages[0][2].select("doc_id").collect()}
    labels = {r["doc_id"]: r["quality"] for r in read(spark, SMALL, "labels").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in kept for d in bad) <= 0.2 * len(bad)


def test_dedup_shrinks_and_packing_covers(spark, stages):
    assert stages[2][2].count() < stages[2][1].count()
    _, docs, packed = stages[4]
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").sum("length").selectExpr("max(`sum(length)`)").first()[0] <= 4096


def test_nulls_repeats_and_clashing_columns(spark):
    """Each filtering stage takes a small table with all that can be odd and gives its columns back."""
    names = ["_d", "_t", "_doc", "_text", "_removed", "score", "lang_pred", "component_id"]
    docs = read(spark, SMALL, "documents").limit(20).selectExpr("*", *(f"'x' as `{n}`" for n in names))
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, None, "s", None), (None, "word " * 30_000, "en", None, 5)], "doc_id long, text string, lang string, source string, n_chars long")
    odd = docs.limit(0).unionByName(odd, allowMissingColumns=True)
    for rows in (docs.unionByName(odd), odd, docs.limit(0)):
        table = materialize(rows, "odd")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SMALL)
            assert out.columns == table.columns and out.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, table, SMALL).select("doc_id").count() >= table.count()


def test_query_is_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11))
