"""The training-data pipeline: quality, line dedup, near-dedup, decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
``run`` applies them in order to ``documents``. Each stage's rows are written as Parquet in the shared
folder and read again by the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm import line_dedup, packing, quality, simhash, tiling
from dimweave.llm.common import materialize, read, ship_code
from dimweave.llm.queries import tokenizer_path


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that occurred before and repeated short lines; ``n_chars`` follows the text."""
    kept = line_dedup.remove_later_runs(docs, short_times=line_dedup.SHORT_TIMES)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link (three-word shingles, three or fewer of 64 bits)."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return tiling.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), window=2048, end_id=1)


STAGES = [
    ("quality classifier", accept),
    ("line dedup", drop_repeated_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack),
]

ORACLE_SQL = None  # SQL has no tokenizer and no trained classifier


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
