"""The operators' registered queries (whole tables, production parameters) and,
where SQL can express one, its DuckDB text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from darkroom.llm.best_fit_packing import pack_documents
from darkroom.llm.bounded_ring import shard_rows
from darkroom.llm.bpe_codec import encode_documents
from darkroom.llm.conversation_trie import conversation_trie, numbered_turns, spliced
from darkroom.llm.html_main_text import extract_pages
from darkroom.llm.license_scan import scan_licences
from darkroom.llm.lsh_forest import near_duplicates
from darkroom.llm.posting_lists import nearest_neighbours
from darkroom.llm.quality_rules import quality_rules
from darkroom.llm.repeated_passages import remove_repeats
from darkroom.llm.source_mix import mix_sources
from darkroom.llm.store import ship_package, stored
from darkroom.llm.token_alignment import align_documents, score_links
from darkroom.llm.url_cascade import LISTED_NAMES, judge_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document: the class it belongs to and its number of links."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def document_path() -> Column:
    """`documents` as a tree of files: source/lang/hundred/name; the first of
    each hundred ids is its directory's licence file, the first of each ten
    thousand its language's."""
    n = F.col("doc_id")
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    return (
        F.when(n % 10_000 < 20, F.concat(top, F.lit("/LICENSE."), n.cast("string")))
        .when(n % 100 < 20, F.concat_ws("/", top, F.floor(n / 100).cast("string"), F.concat(F.lit("LICENSE."), n.cast("string"))))
        .otherwise(F.concat_ws("/", top, F.floor(n / 100).cast("string"), F.concat(n.cast("string"), F.lit(".txt"))))
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"), document_path(), ["doc_id"])


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, convs = spliced(numbered_turns(table(spark, sf_dir, "conversations")))
    return conversation_trie(paths, convs).drop("key")


def op12_tree_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(table(spark, sf_dir, "documents"))
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align_documents(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return score_links(stored(aligned.withColumn("groups_sha256", digest).drop("groups"), "align-links"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_source_mix": op2_source_mix,
    "op3_lsh_forest": op3_lsh_forest,
    "op4_html_main_text": op4_html_main_text,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_license_scan": op6_license_scan,
    "op7_url_cascade": op7_url_cascade,
    "op8_posting_lists": op8_posting_lists,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_bounded_ring": op10_bounded_ring,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_tree_codec": op12_tree_codec,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE = {
    "op7_url_cascade": f"""
        WITH parts AS (
            SELECT page_id,
                   CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages
        ), named AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ), ruled AS (
            SELECT *, CASE
                WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/'
                END AS rule
            FROM named
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches('.' || host, '\\.({"|".join(LISTED_NAMES)})\\.example\\.(com|net|org)$') THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled
    """,
}
