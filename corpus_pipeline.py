"""The training corpus pipeline: five stages over ``documents``, each by one operator.

Every stage reads all that the one before it kept, from the Parquet table that was written for it,
and decides on its own input:

1. toxicity: learned from the labelled rows; documents whose score reaches 0.5 go.
2. line dedup: lines that an earlier document holds are cut out; all documents stay.
3. near-dedup: of each group of near copies (similarity of 0.8 or more, runs of five words) the
   document with the smallest id stays.
4. decontamination: documents that hold a window of a benchmark item go (coverage limit 0).
5. packing: what is left becomes sequences of at most 4096 tokens, a row for each piece.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import decontamination, line_dedup, near_dedup, packing, toxicity
from fieldloom.llm.shared import own_folder, read


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs, percent=80)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack_digests(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pieces.withColumnRenamed("doc", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", keep_civil),
    ("line dedup", cut_repeated_lines),
    ("near-dedup", keep_one_of_near_copies),
    ("decontamination", keep_uncontaminated),
    ("packing", pack_sequences),
]

#: Toxicity and packing are a fitted model and a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    docs = read(spark, sf_dir, "documents")
    folder = own_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {}
