"""The training-corpus pipeline: stages over ``documents``, each written and read back before the next.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of ``documents``; the last returns doc_id, token ids and the text decoded from
them. Null texts pass the filters and have no ids; an empty table passes through; what each operator does
with nulls, ties and repeated rows is stated in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import bpe, decontaminate, lines, minhash, toxicity
from candlewick.llm.common import stored, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model does not call toxic."""
    labels = toxicity.labelled(table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, toxicity.fit(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches."""
    return lines.cleaned(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the text they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.round_trip(docs, path)


STAGES = [
    ("toxicity", reject_toxic),
    ("lines", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("contamination", drop_contaminated),
    ("bpe", encode),
]

#: The stages are no SQL: trained scores, similarity joins and token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
