"""The corpus pipeline: documents through five operators, each on all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import new_path, table
from tillroll.llm.decontaminate import remove_contaminated
from tillroll.llm.line_dedup import dedup_lines
from tillroll.llm.mixing import mix
from tillroll.llm.simhash_dedup import keep_representatives
from tillroll.llm.toxicity import drop_toxic, learn, train_rows


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model is learned from the labelled ones outside the held-out fold."""
    return drop_toxic(docs, learn(docs, train_rows(table(spark, sf_dir, "labels"))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, ``n_chars`` follows the text, and documents of which
    no line is left go with them; documents without lines stay as they were."""
    cut = dedup_lines(docs).where("n_lines = 0 OR n_kept > 0")
    kept = cut.withColumn("_n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))
    swap = {"text": F.col("text"), "n_chars": F.when(F.col("n_lines") == F.col("n_kept"), F.col("_row.n_chars"))
            .otherwise(F.col("_n_chars")) if "n_chars" in docs.columns else None}
    return kept.select(*((swap[c] if c in swap else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return keep_representatives(docs, shingle=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture of what is left, in order of virtual finish time."""
    return mix(docs)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("SimHash near-dedup", simhash_dedup),
          ("benchmark decontamination", decontaminate), ("mixing sources to target weights", mixing)]

#: Learning, fingerprints and the latent space are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's rows written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = new_path(spark, f"stage-{number}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
