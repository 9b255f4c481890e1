"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill.llm.backoff_lm import backoff_scores
from creditmill.llm.decontaminate import find_leaks
from creditmill.llm.exact_dedup import exact_dedup
from creditmill.llm.html_text import extract_pages
from creditmill.llm.minhash import near_components
from creditmill.llm.mixing import mix_plan
from creditmill.llm.substring_dedup import substring_dedup
from creditmill.llm.token_counts import count_tokens
from creditmill.llm.token_store import read_tokens, store_tokens
from creditmill.llm.toxicity import THRESHOLD, fit, score_toxicity
from creditmill.llm.url_filter import RULE_SCHEMA, judge_urls
from creditmill.llm.vector_codes import vector_codes
from creditmill.llm.whitening import whitening
from creditmill.sources.readers import read_table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the contract: verdict, host, path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)




def vocabulary() -> str:
    """The vocabulary file, at the place its package has on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mix_plan(table(spark, folder, "documents"))
    return plan.withColumn("parts", F.to_json("parts"))


def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents"))


def op5_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(table(spark, folder, "documents"), similarity=85)


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), vocabulary())


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items that documents hold; a clean document has no row."""
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Labels are learned from rows outside one third, which is held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    scored = score_toxicity(docs, fit(docs, labels, ~held_out))
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"), spark.createDataFrame(list(URL_RULES), RULE_SCHEMA))


def op10_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Encoded, stored, and read back out of the files."""
    return read_tokens(store_tokens(table(spark, folder, "documents"), vocabulary()))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes(table(spark, folder, "embeddings"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening(table(spark, folder, "embeddings"))


def op13_backoff_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Learned from rows outside one fold of five, which is held out."""
    return backoff_scores(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_exact_dedup, op2_mixing, op3_html_text, op4_substring_dedup, op5_minhash, op6_token_counts, op7_decontaminate, op8_toxicity, op9_url_filter, op10_token_store,
        op11_vector_codes, op12_whitening, op13_backoff_lm)
}
