"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hyperminhash, language_id, line_dedup, merkle, mixing, packing, prefix_trie, quality_model, quality_rules, secret_scan, spot_signatures, suffix_dedup, warc
from .common import load, numbered, written
from .oracle_sql import ORACLES  # noqa: F401

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.ledger(load(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(led).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "failed")


@query
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_units(load(spark, sf_dir, "documents"), passage_words=line_dedup.PASSAGE_WORDS)
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return out.select(
        "doc_id", "n_units", F.size("removed").cast("long").alias("n_removed_units"),
        F.col("n_removed").alias("n_removed_chars"), F.array_join(spans, ",").alias("removed_spans"),
        F.sha2(F.encode(F.coalesce("kept_text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(load(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(held, F.lit(False)).alias("held_out"))
    model = language_id.train(docs.where(~F.col("held_out")).select("text", "lang"))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model, F.col("text")).drop("text")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(load(spark, sf_dir, "documents"))
    base = [secret_scan.count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *base, F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.as_text(F.col("spans")).alias("spans"))


@query
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(load(spark, sf_dir, "documents"))


@query
def op5_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spot_signatures.fingerprints(load(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        spot_signatures.as_text(F.col("sigs")).alias("fingerprint"),
        spot_signatures.as_text(F.col("edited_sigs")).alias("edited_fingerprint"),
        spot_signatures.likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        spot_signatures.likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(hit, merkle.leaf(*[lowered if f == "text" else F.col(f) for f in merkle.FIELDS]))
    rows = merkle.manifest(docs, also={"tampered": tampered})
    rows = merkle.verified(rows, F.coalesce("tampered", "leaf"))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                       "folded_root", "verified")


def forked(turns: DataFrame, members: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """Stand-in input of op12: conversation c begins with the first crc32(c) % 6 turns of c - c % 100, then has its own later ones.

    ``turns`` is a written table (conv, at, digest, chars); at most ``most`` turns of each first of a family meet its members.
    """
    def forks(conv: str):
        return F.crc32(F.col(conv).cast("string").cast("binary")) % (most + 1)

    heads = turns.where((F.col("at") < most) & (F.col("conv") % family == 0)).withColumnRenamed("conv", "first")
    taken = members.withColumn("first", F.col("conv") - F.col("conv") % family).join(heads, "first").where(F.col("at") < forks("conv"))
    own = turns.where(F.col("at") >= forks("conv"))
    rows = taken.select("conv", F.lit(0).alias("side"), F.col("at").alias("was"), "digest", "chars").unionByName(
        own.select("conv", F.lit(1).alias("side"), F.col("at").alias("was"), "digest", "chars"))
    return written(numbered(written(rows, "forked"), ["conv"], ["side", "was"], "forked").select("conv", "at", "digest", "chars"), "forked")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turn_rows(load(spark, sf_dir, "conversations"))
    members = written(turns.select("conv").distinct(), "members")
    nodes = prefix_trie.trie(forked(turns, members), members)
    return nodes.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
                        F.col("n_children").cast("long"), F.col("n_leaves").cast("long"), F.col("saved").alias("saved_tokens"), "ends_sha256")


@query
def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_model.measured(load(spark, sf_dir, "documents"))
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = quality_model.train(rows.where(~held), load(spark, sf_dir, "labels"))
    out = quality_model.scores(rows.select("id", "x", held.alias("held_out")), model)
    return out.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))
