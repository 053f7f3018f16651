"""The registered queries of this subpackage: one per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    bpe,
    collocations,
    conversation,
    exact_dedup,
    katz,
    langid,
    line_dedup,
    near_dedup,
    packing,
    quality,
    suffix_dedup,
    url_filter,
    warc,
)
from claimloom.llm.common import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), keep=["doc_id"]))
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a repeated string of 100 bytes covers, removed."""
    return suffix_dedup.cut(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and the verdict of rules and isolation forest."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    predicted = langid.identify(docs, langid.fit(docs), keep=["doc_id"])
    return predicted.select(
        "row.doc_id", langid.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; the largest doc_id stays."""
    return exact_dedup.resolve(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 1024."""
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates: class_id is the smallest doc_id of a document's class."""
    return near_dedup.classify(table(spark, sf_dir, "documents"))


@query
def op8_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to ZIP-packaged archives and read back by range."""
    written = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(written).drop("url", "payload", "record_id", "refers_to_id")


@query
def op9_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a Katz backoff model of the others."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return katz.score(table(spark, sf_dir, "documents"), held)


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that stand on ten sources or more, removed."""
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


#: The rules that the registered query judges URLs by.
URL_RULES = (
    url_filter.Rule("allow", "com"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


@query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL, by rules and by the templates of its host."""
    judged = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "template", "blocked_share")


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations: faults, cheapest repair and its audit."""
    return conversation.audits(conversation.damaged(table(spark, sf_dir, "conversations")), copies="copies")


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two and three words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
