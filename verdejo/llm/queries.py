"""The registered queries of this package and their plain SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from . import chat_windows, conversation_trie, debruijn, decontaminate, gru_lm, html_main, line_dedup, merkle, ngram_join, packing, quality_rules, url_filter, warc
from .kit import Scratch, table
from .oracles import ORACLES  # noqa: F401


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_main.extracted(table(spark, folder, "pages"))


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    return ngram_join.grouped(table(spark, folder, "documents"), Scratch(spark))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    rows = quality_rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"), Scratch(spark))
    return rows.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    return url_filter.judged(table(spark, folder, "pages"), Scratch(spark))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    return line_dedup.deduped(table(spark, folder, "documents").select("doc_id", "text"), Scratch(spark))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    return warc.captures(table(spark, folder, "pages"), Scratch(spark)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    return gru_lm.scored(table(spark, folder, "documents"), Scratch(spark))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    return packing.packed(table(spark, folder, "documents"), word_tokenizer(), Scratch(spark))


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.judged(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("key", "spans")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    return debruijn.removed(table(spark, folder, "documents"), Scratch(spark)).drop("kept")


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    return conversation_trie.trie(table(spark, folder, "conversations"), Scratch(spark))


#: A conversation whose texts are control strings.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    windows = Scratch(spark).keep("windows", chat_windows.windows(rows.union(spark.createDataFrame(PROBE, rows.schema))))
    return chat_windows.digests(chat_windows.read_back(windows))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tune(spark)
    docs, ws = table(spark, folder, "documents"), Scratch(spark)
    return merkle.climb(merkle.build(docs, ws, merkle.tampered(docs.doc_id, docs.text)), ws)


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_ngram_jaccard_join, op3_quality_rules, op4_url_filter, op5_line_dedup, op6_warc, op7_lm_scoring, op8_best_fit_packing,
                                op9_benchmark_decontamination, op10_substring_dedup, op11_conversation_trie, op12_chat_formatting, op13_merkle_manifest)}
