"""The registered queries of this subpackage, with SQL where SQL says the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.llm import (
    contract_sql, language, merkle, mixing, mixing_sql, perplexity, prefix_trie, secret_scan, simhash, sketches, templates, token_files,
    url_rules, warc, winnowing,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path() -> str:
    """The vocabulary file: CHAINLAKE_TOKENIZER, else the installed public one."""
    given = os.environ.get("CHAINLAKE_TOKENIZER")
    if given:
        return given
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op2_main_text(spark, sf_dir):
    found = templates.extracted(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op3_contamination(spark, sf_dir):
    documents, _ = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return documents.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


@query
def op4_warc_derivatives(spark, sf_dir):
    """Pages written as a crawler's response records, read from those files, and derived."""
    files = warc.write_warc(warc.responses(table(spark, sf_dir, "pages")))
    made = warc.derive(warc.read_warc(files))
    return made.select(
        "warc_type", "record_id", "refers_to", "target_uri", "warc_date", "content_type", "block_digest", "payload_digest",
        F.length("block").cast("long").alias("content_length"), F.decode("block", "UTF-8").alias("content"),
    )


@query
def op5_sketches(spark, sf_dir):
    return sketches.edited_pairs(table(spark, sf_dir, "documents"))


@query
def op6_mixture(spark, sf_dir):
    rows, _ = mixing.mixture(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "drawn"
    )


ORACLES["op6_mixture"] = mixing_sql.mixture_sql("documents")


@query
def op7_perplexity(spark, sf_dir):
    return perplexity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_secrets(spark, sf_dir):
    found = secret_scan.secrets(table(spark, sf_dir, "documents"))
    kinds = {f"n_{k}": secret_scan.counted(F.col("base"), i) for i, k in enumerate(secret_scan.KINDS[:3])}
    return found.select(
        "doc_id", *(c.alias(n) for n, c in kinds.items()),
        F.sha2(secret_scan.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


@query
def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    found = language.predict(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op10_token_files(spark, sf_dir):
    shards = token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return token_files.read_tokens(shards, with_tokens=False)


# The rules that the URL query judges by.
URL_RULES = [
    url_rules.Rule("allow", "org", "/"), url_rules.Rule("block", "example.org", "/es/"), url_rules.Rule("block", "example.org", "/en/1"),
    url_rules.Rule("allow", "com", "/fr/"), url_rules.Rule("block", "com", "/de/"),
]


@query
def op11_url_verdicts(spark, sf_dir):
    return url_rules.judged(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


ORACLES["op11_url_verdicts"] = contract_sql.judged_sql("pages", [(r.verdict, r.host, r.path) for r in URL_RULES])


@query
def op12_manifest(spark, sf_dir):
    """Every document's proof against the manifest; a third of the documents are tampered with after it is made."""
    changed, lowered = merkle.tampered("doc_id", "text")
    now = merkle.digest_of([*map(F.col, ("doc_id", "source", "lang", "n_chars")), lowered])
    return merkle.verified(table(spark, sf_dir, "documents"), shown=F.when(changed, now))


ORACLES["op12_manifest"] = contract_sql.manifest_sql("documents")


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("enter", "leave")


ORACLES["op13_prefix_trie"] = contract_sql.trie_sql("conversations")
