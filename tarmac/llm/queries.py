"""Queries over the dealt operators, with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, decontaminate, html_text, language, license_scan, line_quality, pseudo_likelihood, quality_neighbours, ranked_search, simhash_vp, token_store, url_rules, whitening
from tarmac.session import scratch_path

#: fixed values: verdicts and rules of the URL list
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoding of every document, as digests."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), VOCABULARY)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document.

    The table has no paths, so they are made: source, language, hundreds of the id; every
    tenth document is its directory's licence file, and of every thousand one that of its parent.
    """
    docs = _table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", "source", "lang", (F.col("doc_id") / 1000).cast("long"))
    deep = F.concat_ws("/", folder, (F.col("doc_id") / 100).cast("long"))
    path = (
        F.when(F.col("doc_id") % 1000 < 10, F.concat(folder, F.lit("/LICENSE-"), F.col("doc_id")))
        .when(F.col("doc_id") % 10 == 0, F.concat(deep, F.lit("/LICENSE-"), F.col("doc_id")))
        .otherwise(F.concat(deep, F.lit("/"), F.col("doc_id"), F.lit(".txt")))
    )
    return license_scan.scan(docs.select("doc_id", "text", path.alias("path")), "doc_id")


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by the rule list, else by rules of any length mined from the labels."""
    return url_rules.judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"), URL_RULES, most_tokens=None)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as Re-Pair blocks, read back from the files."""
    path = scratch_path(spark, "token-store")
    token_store.write_store(_table(spark, sf_dir, "documents"), path, VOCABULARY, end_id=2)
    return token_store.read_store(spark, path)


def op5_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    return line_quality.judge(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_vp.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four of five folds."""
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    folds = docs.select("doc_id", "text", language.held_out().alias("held_out"))
    said = language.predict(folds.select(F.struct("doc_id", "held_out").alias("row"), "text"), model, id_col="row")
    return said.select("row.doc_id", "row.held_out", "lang_pred", "score", "ambiguous")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on the corpus."""
    docs = _table(spark, sf_dir, "documents")
    return pseudo_likelihood.score(docs, pseudo_likelihood.fit(docs))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op11_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of two of three folds."""
    docs = _table(spark, sf_dir, "documents")
    model = quality_neighbours.train(docs, _table(spark, sf_dir, "labels"))
    folds = docs.select(F.struct("doc_id", quality_neighbours.held_out().alias("held_out")).alias("row"), "text")
    return quality_neighbours.score(folds, model, id_col="row").select("row.doc_id", "row.held_out", "score", "predicted")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first four components, whitened."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_url_rules": op3_url_rules,
    "op4_token_store": op4_token_store,
    "op5_line_quality": op5_line_quality,
    "op6_simhash": op6_simhash,
    "op7_language": op7_language,
    "op8_decontamination": op8_decontamination,
    "op9_pseudo_likelihood": op9_pseudo_likelihood,
    "op10_html_text": op10_html_text,
    "op11_quality_neighbours": op11_quality_neighbours,
    "op12_ranked_search": op12_ranked_search,
    "op13_whitening": op13_whitening,
}
