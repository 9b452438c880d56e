import __spark_entry__ as driver
import corpus_pipeline
from depthframe.llm import near_dedup
from depthframe.llm.common import Scratch

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = driver.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch = Scratch(spark, "t")
    columns, sizes, held = docs.columns, [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES:
        held = scratch.stage(stage(spark, held, SF), name)
        sizes.append(held.count())
        if name != "sentencepiece":
            assert held.columns == columns and held.dtypes == docs.dtypes
        if name == "near_dedup":
            again = near_dedup.near_duplicates(held, 5, 80).filter("doc_id <> component_id").count()
            assert again == 0
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 100 and sizes[4] == sizes[5]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    first = corpus_pipeline.quality_stage(spark, docs, SF)
    assert len(good - {r.doc_id for r in first.collect()}) <= len(good) // 50


def test_release_deletes_what_was_staged(spark):
    from depthframe.llm import common

    scratch = Scratch(spark, "t")
    staged = scratch.stage(spark.range(3), "x")
    path = spark._jvm.org.apache.hadoop.fs.Path(staged._staged_at)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert files.exists(path)
    common.release(spark)
    assert not files.exists(path)


def test_last_stage_decodes_its_pieces(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    out = corpus_pipeline.piece_stage(spark, docs, SF)
    assert out.columns == [*docs.columns, "ids", "round_trip"]
    assert [r.round_trip for r in out.collect()] == [True] * 40


def test_empty_table_through_all_stages(spark):
    held = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    scratch = Scratch(spark, "empty")
    for name, stage in corpus_pipeline.STAGES:
        held = scratch.stage(stage(spark, held, SF), name)
        assert held.count() == 0
    assert held.columns[-2:] == ["ids", "round_trip"]


def test_own_counts_come_through_the_line_stage(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(1, passage, 1, "mine"), (2, f"own words\n{passage}", 2, "other"), (3, passage, 3, "gone"), (4, None, 0, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_gone int, n_lines string").selectExpr("*", "cast(length(text) as long) as n_chars")
    out = corpus_pipeline.line_stage(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted((r.doc_id, r.text, r.n_gone, r.n_lines, r.n_chars) for r in out.collect())
    assert got == [(1, passage, 1, "mine", len(passage)), (2, "own words", 2, "other", 9), (4, None, 0, None, None)]
