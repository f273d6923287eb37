"""The corpus pipeline: stages over ``documents``, each a training-data operator.

Every stage takes all that the one before kept. Stages but the last return the columns of
documents. Each row is judged for itself: a stage gives every row of its input a key of its
own, the operators carry it, and rows go by it, so null and repeated ids decide nothing
about each other. Of rows with equal or linked texts the one of the least id stays, a row with
a null id only where no other has one. Null texts have no letters, so language identification
rejects them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm.common import stored, table
from spendlens.llm.decontamination import contamination
from spendlens.llm.exact_dedup import exact_dedup
from spendlens.llm.language_id import accepted_rows
from spendlens.llm.sentencepiece_tokens import sentencepiece_tokens
from spendlens.llm.simhash import simhash_firsts


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Rows with a key of their own that every reading gives again: file and place in it, or else it is written.

    The key's name is one that the table doesn't have."""
    spark, taken = docs.sparkSession, {c.lower() for c in docs.columns}
    free = lambda name: next(n for n in (name, *(f"{name}{i}" for i in range(len(taken) + 1))) if n not in taken)
    key, file, number, place = map(free, ("pipeline_row", "pipeline_file", "pipeline_number", "pipeline_place"))
    # a table as read; behind a join or an explode, places in files would repeat
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            at = docs.metadataColumn("_metadata")
            placed = docs.select("*", at["file_path"].alias(file), at["row_index"].alias(place))
            names = sorted(r[0] for r in placed.select(file).distinct().collect())  # as many as files
            files = spark.createDataFrame(list(enumerate(names)), f"{number} long, {file} string")
            return placed.join(F.broadcast(files), file).select(
                *[F.col(f"`{c}`") for c in docs.columns], F.expr(f"shiftleft({number}, 40) + {place}").alias(key)), key
        except AnalysisException:
            pass  # a source without places
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def _without(docs: DataFrame, keys: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows whose key is not among what ``keys`` gives for the keyed rows.

    Few rows go, so their keys are written first: then Spark knows how small they are, broadcasts them
    below its threshold and leaves the texts where they are.
    """
    keyed, key = _keyed(docs)
    gone = stored(keys(keyed, key).select(key), "rejected")
    return keyed.join(gone, key, "left_anti").select([f"`{c}`" for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted with enough confidence."""
    return accepted_rows(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _without(docs, lambda rows, key: exact_dedup(rows, key_col=key).where("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash fingerprints."""
    def others(rows, key):
        return rows.select(key).join(simhash_firsts(rows, key).select(key), key, "left_anti")

    return _without(docs, others)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = table(spark, sf_dir, "benchmark")
    return _without(docs, lambda rows, key: contamination(rows, benchmark, key_col=key).where("contaminated"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return sentencepiece_tokens(docs)


STAGES = [("language id", language), ("exact dedup", exact), ("simhash near-dedup", near),
          ("benchmark decontamination", clean_of_benchmark), ("sentencepiece", tokens)]
#: A trained classifier and a tokenizer are not SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
