"""A training corpus in five stages, each one of the operators in ``tidecast/llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame,
which is written as Parquet and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``:

1. quality: documents that the rule ensemble rejects go;
2. near_duplicates: one document of each class stays;
3. decontamination: documents that hold a benchmark window go;
4. pii: personal data is masked in the texts;
5. sentencepiece: doc_id, the token ids and their number.

Defined results: an empty table passes every stage; null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidecast.llm import _shared, decontaminate, neardup, pieces, pii, quality

#: No SQL: the fitted classifier, the sketches and the token ids have no SQL form; the stages
#: are tested against brute-force versions.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    coded = pieces.encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("sentencepiece", sentencepiece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = _shared.table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
