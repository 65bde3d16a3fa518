"""Corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, personal data, piece encoding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. All stages but the last return the columns of their
input; stages that change a text set ``n_chars`` anew where that column
exists. ``run`` writes each stage's rows, reads them again for the next and
then removes what the stage wrote for itself. Extra columns pass through
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm import op01_automaton, op02_mcd, op07_gumbel_pieces, op08_weak_pii, op09_partenum
from tallystar.llm.names import free_name
from tallystar.session import SCRATCH, cut_lineage, drop_scratch_since
from tallystar.sources.testdata import read_table


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the base rules or lie far from their group go."""
    verdict = free_name(docs, "__quality")
    return op02_mcd.judge(docs, column=verdict).where(f"{verdict}.kept").select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return op09_partenum.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; texts that are mostly such passages go."""
    return _counted(op01_automaton.decontaminate(docs, read_table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return _counted(op08_weak_pii.redact(docs))


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece segmentations of each text."""
    return op07_gumbel_pieces.encode(docs.select("doc_id", "text")).select("doc_id", "text", "samples")


STAGES = [("quality_rules", quality_rules), ("jaccard_join", jaccard_join), ("decontamination", decontamination),
          ("personal_data", personal_data), ("piece_encoding", piece_encoding)]

# Robust covariance, component search and sampling have no SQL form; the
# pipeline is tested against a brute-force version in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = read_table(spark, sf_dir, "documents"), len(SCRATCH)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
        drop_scratch_since(spark, mark)          # what the stage wrote for itself, and its input
    return STAGES[-1][1](spark, docs, sf_dir)
