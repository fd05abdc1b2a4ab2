"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from rankwell.llm import bpe, decontaminate, language_id, license_scan, lm_scoring, minhash, quality, ranked_search, simhash, toxicity, url_filter, warc, whitening
from rankwell.sources.tables import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _lm_scoring(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lm_scoring.score(docs, lm_scoring.learned(docs))


def _license_scan(spark, folder):
    found = license_scan.scan(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    phrases = F.array_distinct(F.transform("places", lambda p: p["label"]))
    whole = F.filter("spans", lambda s: s["coverage"] >= license_scan.COVERED)
    spans = F.transform(whole, lambda s: s["label"])
    starts = F.transform("places", lambda p: p["start"])
    best = F.array_max(F.transform("spans", lambda s: s["coverage"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(phrases), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(phrases, spans)), ",").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def _decontaminate(spark, folder):
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontaminate.scan(docs, items, ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _bpe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judge_measured(quality.measured(docs)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.col("rejected_by").isNull().alias("kept"),
    )


def _warc(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return warc.read(warc.archive(pages), payload=False).drop("url")


def _url_filter(spark, folder):
    # Labels are of documents and say nothing of a page, so the rules' verdicts are the outcomes.
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def _toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    weights = toxicity.fit(docs, labels.filter(~toxicity.held_out(labels)))
    marked = docs.withColumn("held_out", toxicity.held_out(docs))
    return toxicity.score(marked, weights).drop("text")


def _language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held = language_id.learned(docs)
    model = language_id.fit(docs.filter(~held))
    marked = docs.select("doc_id", "text", held.alias("held_out"))
    return language_id.identify(marked, model).drop("text")


def _simhash(spark, folder):
    found = simhash.components(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def _ranked_search(spark, folder):
    docs, items = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    return ranked_search.search(docs, items)


def _minhash(spark, folder):
    return minhash.components(table(spark, folder, "documents").select("doc_id", "text"))


def _whitening(spark, folder):
    return whitening.components(table(spark, folder, "embeddings").select("vec_id", "embedding"))


QUERIES = {
    "op1_lm_scoring": _lm_scoring,
    "op2_license_scan": _license_scan,
    "op3_bpe": _bpe,
    "op4_decontaminate": _decontaminate,
    "op5_quality": _quality,
    "op6_warc": _warc,
    "op7_url_filter": _url_filter,
    "op8_toxicity": _toxicity,
    "op9_language_id": _language_id,
    "op10_simhash": _simhash,
    "op11_ranked_search": _ranked_search,
    "op12_minhash": _minhash,
    "op13_whitening": _whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": decontaminate.ORACLE_SQL,
    "op5_quality": quality.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
    "op7_url_filter": url_filter.ORACLE_SQL,
    "op11_ranked_search": ranked_search.ORACLE_SQL,
    "op12_minhash": minhash.ORACLE_SQL,
}
