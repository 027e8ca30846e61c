"""The operators of this package as queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streakline.llm import ann, bpe, exact, mixing, pii, simhash, sketch, substrings, suffixes, toxicity, trie, urls, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_mix_sources(spark, sf):
    return mixing.mix_sizes(table(spark, sf, "documents"))


SQL["op1_mix_sources"] = mixing.SQL


@query
def op2_toxicity(spark, sf):
    return toxicity.judge_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op3_repeated_substrings(spark, sf):
    return substrings.measure_repeats(table(spark, sf, "documents"))


@query
def op4_bpe_round_trip(spark, sf):
    return bpe.measure_encoding(table(spark, sf, "documents"))


@query
def op5_near_duplicates(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op6_personal_data(spark, sf):
    return pii.find_personal_data(table(spark, sf, "documents"))


@query
def op7_nearest_neighbours(spark, sf):
    return ann.nearest_neighbours(table(spark, sf, "embeddings"))


@query
def op8_fingerprints(spark, sf):
    return sketch.compare_edits(table(spark, sf, "documents"))


@query
def op9_filter_urls(spark, sf):
    pages = table(spark, sf, "pages")
    return urls.judge_urls(pages, urls.urls_by_words(pages))


SQL["op9_filter_urls"] = urls.SQL


@query
def op10_suffix_repeats(spark, sf):
    return suffixes.measure_repeats(table(spark, sf, "documents"))


@query
def op11_whitening(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings"))


@query
def op12_exact_duplicates(spark, sf):
    return exact.grouped(table(spark, sf, "documents"))


SQL["op12_exact_duplicates"] = exact.SQL


@query
def op13_prefix_trie(spark, sf):
    return trie.prefix_trie(table(spark, sf, "conversations"))


SQL["op13_prefix_trie"] = trie.SQL
