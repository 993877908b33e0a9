"""The corpus pipeline: from raw documents to a weighted mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents.

1. quality: documents that the classifier rejects go;
2. near copies: of each component of near copies (five words, Jaccard 0.8) one document stays;
3. benchmark: documents that hold a passage of the benchmark go;
4. secrets: spans are replaced by a mark;
5. mixture: documents are chosen to meet the target weights, with the passes each is read in.

A row without text counts as an empty text in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontaminate, jaccard, mixing, quality, secrets
from shelfmark.llm._session import deleted, table, written_at

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores above the cut. Rows without an id are scored as others; repeated
    rows are kept or go together; without labels all stay."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the smallest id, of equal ids the smallest hash of the text, then of the row. Texts
    without words are no copies of each other; of equal ones with one id one stays."""
    return jaccard.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; items without text match nothing, and without items all stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and n_chars to match; texts without secrets, null ones too, are as they were."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, with domain, n_tokens and epochs; ties in the order of a leaf are in or out together."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
]
#: The quality classifier is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = written_at(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        if before:
            deleted(before)  # nothing reads the stage before any more
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
