"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    html_text,
    line_dedup,
    mixing,
    pii,
    quality_model,
    quality_rules,
    resampling,
    sentence_pieces,
    simhash,
    substring_dedup,
    suffix_dedup,
    vector_codes,
)
from .oracle import ORACLES as ORACLES

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mixture(spark, sf_dir):
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op2_decontaminate(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark(documents, _table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort("items"), ",")
    return marked.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(ids, 256).alias("items_sha256"), "contaminated")


@query
def op3_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_pii(spark, sf_dir):
    rows = pii.find_personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.coalesce("personal", F.array().cast("array<struct<place:int,start:long,end:long,kind:string,base:boolean>>"))
    base = F.filter(spans, lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda array: F.array_join(
        F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return rows.select(
        "doc_id", *(count(kind) for kind in pii.BASE), F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans")
    )


@query
def op5_substring_dedup(spark, sf_dir):
    rows = substring_dedup.dedup_substrings(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op6_suffix_dedup(spark, sf_dir):
    rows = suffix_dedup.dedup_bytes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_quality_model(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit(documents, _table(spark, sf_dir, "labels"))
    scored = quality_model.score(documents, model)
    return scored.select("doc_id", quality_model.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op8_quality_rules(spark, sf_dir):
    rows = quality_rules.ledger(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"), quality_rules.passes("v1").alias("kept"), "failed_bits",
    )


@query
def op9_html_text(spark, sf_dir):
    return html_text.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


@query
def op10_line_dedup(spark, sf_dir):
    rows = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op11_resampling(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = resampling.resample(documents, _table(spark, sf_dir, "benchmark"), percent=25, least_words=20, seed=7)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_sentence_pieces(spark, sf_dir):
    import public_tokenizers

    model = sentence_pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    rows = sentence_pieces.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    digests = F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    return rows.select("doc_id", "n_tokens", *digests)


@query
def op13_vector_codes(spark, sf_dir):
    coded, codebooks = vector_codes.compress(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = F.lit(vector_codes.codebooks_digest(codebooks)).alias("codebooks_sha256")
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", digest)
