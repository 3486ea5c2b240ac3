"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

Every stage is written as Parquet and read again. Clean documents pass unchanged; the
last stage adds what the mix takes of each.

Documents with a null or empty text, or without a letter, go in the first stage. Of repeated
rows, copies and rows of one class one stays in the second, that with the smallest id, or
one without an id if none has one. Texts are read whole, however long. All stages but the last
keep further columns, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import decontamination, language_cnn, pii_surrogates, simhash_dedup, source_mix
from fleetlens.llm.queries import DEMO_KEY
from fleetlens.llm.shared import table, text_batches, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go."""
    text_batches(spark)
    net = language_cnn.train(docs.where(~language_cnn.held_out(F.col("doc_id"))).select("text", "lang"))
    return language_cnn.accepted(docs, net)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash class (four words, four bits, as in op4) the document with the smallest doc_id stays."""
    text_batches(spark)
    return simhash_dedup.one_of_each(docs, distance=4, width=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; ``n_chars`` of changed texts is counted anew."""
    text_batches(spark)
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    changed = pii_surrogates.replace_entities(docs.select(row.alias("__row"), "text"), DEMO_KEY)
    length = F.when(F.size("entities") > 0, F.length("text").cast("long")).otherwise(F.col("__row.n_chars"))
    new = {"text": F.col("text"), "n_chars": length}
    return changed.select(*[new.get(name, F.col(f"__row.`{name}`")).alias(name) for name in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return source_mix.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("pii_surrogates", replace_personal_data),
    ("source_mix", mix_sources),
]

# Training, fingerprints and surrogates can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name, merged=False)
    return docs
