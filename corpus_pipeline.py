"""The corpus pipeline: toxicity, near-duplicates, benchmark leaks, source mixing, token blocks.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept, read again from Parquet; all but the
last return the columns of ``documents``.  ``run`` applies them to the ``documents`` table, cutting between stages
with a dataset in the shared folder, so a lost executor costs no more than the stage it worked on.

Defined cases, the same in all stages: a null text counts as empty and is clean; null ids are kept; rows that repeat id and
text are one document for near-dedup and separate rows elsewhere; among equally good rows of a class the one of least id
(then text) stays; documents without words weigh nothing in the mix and follow their source's rate; further columns pass through, whatever
their names; an empty table gives an empty result; labels and benchmark may be empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import decontaminate, mixing, near_dedup, token_blocks, toxicity
from hearth.llm.common import cut, table, work_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below one half; the model learns from the labels that are not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.keep_one(spark, docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target says."""
    sized = docs.select("source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.emit(docs, cut(spark, mixing.source_targets(sized)))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks of the corpus, written and read back: a row for each document in them."""
    path = work_path(spark, "tokens")
    token_blocks.write(token_blocks.encode(docs, public_tokenizers.path("byte_bpe_50k.json")), path)
    return token_blocks.decode(token_blocks.read(spark, path))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_blocks", write_tokens),
]

ORACLE_SQL = None  # learned, probabilistic and binary stages: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            path = work_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
