"""The corpus pipeline: stages over `documents`, each written as Parquet and read again by the next.

Every stage but the last returns the columns of `documents`; the last returns one row per packed
piece. What each stage does with nulls, empty texts, ties and repeated rows is stated in its
operator's module.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratastar.llm import language_id, mixing, near_dup, packing, substring_dedup
from stratastar.llm.queries import MIX, domain_of, tokenizer
from stratastar.session import remove, scratch_path, scratch_scope

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text less familiar than this (see language_id) is in no learned language and is rejected, as is one without letters.
LEAST_FAMILIAR = 0.3
#: Least similarity, in percent, of two documents of which the pipeline keeps one.
NEAR = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows stay, unchanged."""
    found = language_id.predicted(docs, language_id.train(docs), carry=tuple(docs.columns))
    return found.where((F.col("lang_pred") != "und") & (F.col("familiar") >= LEAST_FAMILIAR)).select("carried.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return near_dup.without_near_duplicates(docs, NEAR)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of 20 words or more are cut out, and n_chars follows the text.

    A document that loses nothing keeps its text as it is; one that loses every word goes.
    """
    others = [name for name in docs.columns if name != "text"]  # the text itself travels once
    cut = substring_dedup.cut_repeats(docs, carry=tuple(others), as_it_was=True)
    own = {name: F.col("kept_text") if name == "text" else F.col("carried").getField(name) for name in docs.columns}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(own["n_chars"]).cast(docs.schema["n_chars"].dataType)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return left.select(*(column.alias(name) for name, column in own.items()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document."""
    taken = mixing.mixed(docs, domain_of(F.col("source")), MIX, carry=tuple(docs.columns))
    return taken.select("carried.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.packed(docs, tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("packing", pack),
]

#: SQL cannot express the classifier and the tokenizer; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' last result. What a stage stores on its way goes when its result is written, and its input after that."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.schema(result.schema).parquet(path), path
    return docs
