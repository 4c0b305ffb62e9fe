"""Queries of the operators with their checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from evidentia.llm import alignment, ann, conversations, langid, merge_automaton, mixing, neardup, pieces, quality, repeats, secrets, token_counts, token_files
from evidentia.plans.catalog import Catalog

catalog = Catalog()


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@catalog.add("op1_near_duplicates", neardup.SQL)
def op1_near_duplicates(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@catalog.add("op2_secret_scan", secrets.SQL)
def op2_secret_scan(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    ledger, paths = secrets.update_ledger(docs, path="doc_id")
    return secrets.digest(secrets.findings(paths, ledger))


@catalog.add("op3_mix_sources", mixing.SQL)
def op3_mix_sources(spark, folder):
    docs = table(spark, folder, "documents")
    return mixing.mix(docs, mixing.tempered_weights(docs))


@catalog.add("op4_sentencepiece")
def op4_sentencepiece(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.digest(pieces.tokenise(docs, vocabulary("piece_bpe_32k.model")))


@catalog.add("op5_token_files")
def op5_token_files(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    written = token_files.write_files(docs, vocabulary("word_bpe_49k.json"))
    return token_files.read_documents(spark, written, ids=False)


@catalog.add("op6_quality_rules", quality.SQL)
def op6_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@catalog.add("op7_repeated_passages")
def op7_repeated_passages(spark, folder):
    return repeats.digest(repeats.without_repeats(table(spark, folder, "documents").select("doc_id", "text")))


@catalog.add("op8_language_id")
def op8_language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    rows = langid.identify(docs.select("doc_id", "text"), model)
    return rows.select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )


@catalog.add("op9_nearest_neighbours")
def op9_nearest_neighbours(spark, folder):
    return ann.nearest_neighbours(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@catalog.add("op10_token_counts")
def op10_token_counts(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model")).drop("text")


@catalog.add("op11_byte_bpe")
def op11_byte_bpe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return merge_automaton.digest(merge_automaton.tokenise(docs, vocabulary("byte_bpe_50k.json")))


@catalog.add("op12_conversation_repair")
def op12_conversation_repair(spark, folder):
    return conversations.repair(conversations.damage(table(spark, folder, "conversations")))


@catalog.add("op13_token_alignment")
def op13_token_alignment(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return alignment.link_documents(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
