"""A corpus from documents: five stages, each written as Parquet and read again.

Language identification drops documents that it rejects; near-duplicates leave
one document of each group; secrets are masked; sources are mixed to target
weights by replication; texts become SentencePiece ids. All stages but the last
return the columns of documents. The same document may occur several times
behind the mixing stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evidentia.llm import langid, mixing, neardup, pieces, secrets
from evidentia.llm.common import columns, stored
from evidentia.llm.queries import vocabulary


def _own_columns(docs: DataFrame, results: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` behind a stage that adds ``results``, also where ``docs`` has columns of these names."""
    private = [f"__own_{i}" if c.lower() in results else c for i, c in enumerate(docs.columns)]
    staged = stage(docs.toDF(*private))
    return staged.select(*columns(docs.toDF(*private))).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; models of all labelled documents of this stage's input."""
    model = langid.fit(docs)
    names = ("lang_pred", "score", "cross_entropy", "rejected")
    return _own_columns(docs, names, lambda rows: langid.identify(rows, model).where("not rejected"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked."""
    ledger, paths = secrets.update_ledger(docs.select("doc_id", "text"), path="doc_id")
    return secrets.redact(docs, secrets.findings(paths, ledger))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents at the rates that give each source its tempered share, globally shuffled."""
    weights = mixing.tempered_weights(docs)
    return _own_columns(docs, ("copy", "mix_key"), lambda rows: mixing.mix(rows, weights))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and what they decode to."""
    return pieces.tokenise(docs.select("doc_id", "lang", "source", "text"), vocabulary("piece_bpe_32k.model")).drop("text")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]
#: Language models and merges aren't SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
