"""One query for each operator, and the SQL that must give the same rows where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from respan.lineage import scratch_path
from respan.llm.binids import read_digests, write_ids
from respan.llm.decontaminate import mark_contamination
from respan.llm.jaccard import jaccard_components
from respan.llm.lexsearch import build_index, search
from respan.llm.linededup import remove_lines
from respan.llm.oracles import CONTAMINATION, NEAR_COPIES, RANKED, REPEATS, SECRETS
from respan.llm.pieces import piece_digests
from respan.llm.pii import find_pii
from respan.llm.repetition import measure_quality
from respan.llm.secrets import find_secrets
from respan.llm.substrings import remove_repeats
from respan.llm.toxicity import SAMPLE_ROWS, fit_toxicity, labelled_sample, score_toxicity
from respan.llm.urlfilter import Rule, fit_urls, fitting_rule, judge_urls, url_host, url_path
from respan.llm.whitening import fit_whitening, whiten

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = mark_contamination(documents(spark, sf_dir), benchmark, keep=["doc_id"])
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_quality(documents(spark, sf_dir), keep=["doc_id"])


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = fit_toxicity(labelled_sample(docs, labels.where(~held_out), SAMPLE_ROWS))
    return score_toxicity(docs, model, keep=["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_lines(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(documents(spark, sf_dir), PIECE_MODEL, keep=["doc_id"])


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), digest=True)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of its SQL; every link is written on the way, see op9_jaccard_links for their numbers."""
    return jaccard_components(documents(spark, sf_dir), count_links=True).drop("n_links")


def op9_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), count_links=True)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(documents(spark, sf_dir), path, BYTE_TOKENIZER)
    return read_digests(spark, path)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = search(build_index(docs), items, docs.schema["doc_id"].dataType)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


URL_RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages carry no labels: urls that a rule blocks are labelled so, all others count as good.

    Taking only what rules decide would teach the trees to block any domain of which rules know nothing but blocked urls.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    decided = fitting_rule(url_host(F.col("url")), url_path(F.col("url")), URL_RULES)[1]
    model = fit_urls(pages.select("url", F.coalesce(decided == "block", F.lit(False)).alias("blocked")))
    return judge_urls(pages, model, URL_RULES, keep=["page_id"])


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = fit_whitening(vectors)
    rows = whiten(vectors, model, keep=["vec_id"]).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    n, shares, error = (0, [], 0.0) if model is None else (model.n, [float(v / model.trace) if model.trace else 0.0 for v in model.values], model.identity_error)
    explained = F.get(F.array(*[F.lit(s) for s in shares]).cast("array<double>"), F.col("i"))
    return rows.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_secrets, op3_quality_rules, op4_toxicity, op5_pii, op6_line_dedup, op7_sentencepiece, op8_substring_dedup, op9_jaccard_join, op9_jaccard_links, op10_token_ids,
        op11_ranked_search, op12_url_filter, op13_embedding_whitening,
    )
}

#: The others have no SQL: they are checked against the libraries, plain versions and held-out labels in tests/llm.
ORACLES: dict[str, str] = {
    "op1_decontamination": CONTAMINATION,
    "op2_secrets": SECRETS,
    "op8_substring_dedup": REPEATS,
    "op9_jaccard_join": NEAR_COPIES,
    "op11_ranked_search": RANKED,
}
