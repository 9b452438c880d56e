"""The training-data pipeline: a document table through five stages, each written and read again.

1. quality classifier: documents that it rejects go;
2. line dedup: passages that an earlier document holds are deleted from later ones, and
   documents of which nothing is left go;
3. MinHash near-dedup: one document of each group of near copies stays (five-word shingles, 0.8);
4. benchmark decontamination: documents with a window of a benchmark item go;
5. SentencePiece: the piece numbers of what is left, and whether they decode to the text again.

All stages but the last return the columns of documents, other columns of theirs included; the last
adds ids and round_trip, in place of columns of these names.

Defined results: a null or empty text is scored like any other, shares no passage, is no near copy, holds no
benchmark window and has no pieces, so only the first stage decides on it; documents without doc_id are
never dropped as copies; of repeated rows one stays (the near-dedup stage), of tied copies the one with the
smallest doc_id; an empty table passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthframe.llm import decontaminate as bench
from depthframe.llm import line_dedup, near_dedup, pieces, quality
from depthframe.llm.common import Scratch

NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = {c: f"__own_{c}" for c in docs.columns if c in ("n_chars", "n_lines", "n_gone")}
    cut = line_dedup.drop_passages(docs.withColumnsRenamed(own))
    emptied = (F.col("n_gone") > 0) & (F.trim(F.translate("text", "\n\t\r", "   ")) == "")
    size = F.when(F.col("n_gone") > 0, F.length("text").cast("long")).otherwise(F.col("__own_n_chars"))
    kept = cut.filter(~F.coalesce(emptied, F.lit(False)))
    return kept.select(*[size.alias(c) if c == "n_chars" else F.col(own.get(c, c)).alias(c) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs, NEAR_WORDS, NEAR_PERCENT).select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bench.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = pieces.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    own = [c for c in docs.columns if c not in ("ids", "round_trip")]
    return pieces.encode(docs.select(own), model, round_trip="round_trip").select(*own, "ids", "round_trip")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("sentencepiece", piece_stage),
]

#: SQL cannot express the classifier, the alignment or the encoder; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
