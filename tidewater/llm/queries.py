"""One query for each operator, over whole tables, and SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import (decontaminate, jaccard, langid, neighbours, packing, periodic, pii, quality, recompress, rules, sql, suffixes,
               trie, warc)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(C.crc_mod("doc_id", 3) == 1, F.lit(False))
    identifier = langid.learn(docs.filter(~held_out))
    return langid.identified(docs.select("doc_id", "text"), identifier, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), F.col("lang_best").alias("lang_pred"), "score", "cross_entropy", "rejected")


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(_documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(_documents(spark, sf_dir))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(_documents(spark, sf_dir))


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return rules.judged(docs, rules.fit(docs, C.table(spark, sf_dir, "labels"))).drop("anomaly")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(_documents(spark, sf_dir), C.table(spark, sf_dir, "benchmark"), with_text=False)


def tokenizer() -> dict[str, str]:
    """The tokenizer's file, the same vocabulary as ranks, and its split pattern."""
    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
            "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = C.shared_folder(spark)
    manifest = warc.write(C.table(spark, sf_dir, "pages"), folder)
    return warc.read(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(_documents(spark, sf_dir), **tokenizer()))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = quality.fit(docs, C.table(spark, sf_dir, "labels").filter(~quality.held_out()))
    return quality.scored(docs, model, with_text=False).select(
        "doc_id", quality.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op10_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.removed(_documents(spark, sf_dir))


def op11_crosspolytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = C.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0)


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(_documents(spark, sf_dir), weave=True)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.rebuilt(trie.sequences(C.table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_language": op1_language,
    "op2_suffixes": op2_suffixes,
    "op3_pii": op3_pii,
    "op4_jaccard": op4_jaccard,
    "op5_rules": op5_rules,
    "op6_decontaminate": op6_decontaminate,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_quality": op9_quality,
    "op10_recompression": op10_recompression,
    "op11_crosspolytope": op11_crosspolytope,
    "op12_periodic": op12_periodic,
    "op13_trie": op13_trie,
}

SQL: dict[str, str] = dict(sql.STATEMENTS)
