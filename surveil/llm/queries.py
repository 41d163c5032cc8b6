"""The contract queries of the training-data operators: ``QUERIES`` and ``ORACLE``.

Each reads its whole table, calls its operator with production parameters and
derives the contract's columns from the operator's output.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.llm import (
    alignment, chat_format, decontaminate, exact_dedup, langid, mixing, passages, periodic, pieces, quality, sharding, simhash,
    url_filter)
from surveil.llm.common import bound_batches, stage, table
from surveil.llm.oracle import CHAT_SQL, DECONTAMINATION_SQL, EXACT_SQL, MIXING_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bound_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_simhash")
def q_simhash(spark, sf):
    docs = table(spark, sf, "documents")
    prints = stage(docs.select("doc_id", simhash.fingerprint_column(F.col("text")).alias("fp")), "simhash-fingerprints")
    grouped = simhash.near_duplicates(prints)
    return grouped.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


@register("op2_chat_format", CHAT_SQL)
def q_chat(spark, sf):
    probe = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    events = chat_format.conversation_events(rows)
    back = chat_format.read_back(chat_format.render(chat_format.fold_events(events)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


@register("op3_passages")
def q_passages(spark, sf):
    return passages.repeated_passages(table(spark, sf, "documents"))


@register("op4_decontaminate", DECONTAMINATION_SQL)
def q_decontaminate(spark, sf):
    blocks = decontaminate.build_blocks(table(spark, sf, "benchmark"))
    found = decontaminate.scan(table(spark, sf, "documents").select("doc_id", "text"), blocks)
    return found.select("doc_id", "n_words", decontaminate.hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def held_out(modulus: int, remainder: int):
    """Whether crc32(doc_id as text) mod ``modulus`` is ``remainder``; never for a null id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


@register("op5_quality")
def q_quality(spark, sf):
    docs = table(spark, sf, "documents")
    weights = quality.train(docs, table(spark, sf, "labels"), ~held_out(5, 0))
    scored = quality.score(docs.select("doc_id", "text"), weights)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


#: The rules of the contract.
URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


@register("op6_url_filter")
def q_url_filter(spark, sf):
    judged = url_filter.judge(table(spark, sf, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("block_score", 6).alias("block_score"))


@register("op7_mix_sources", MIXING_SQL)
def q_mix(spark, sf):
    mixed = mixing.mix_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


N_SHARDS = 16


@register("op8_shard")
def q_shard(spark, sf):
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return sharding.shard_rows(rows, N_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@register("op9_language_id")
def q_language(spark, sf):
    docs = table(spark, sf, "documents")
    model = langid.train(docs, ~held_out(4, 2))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


@register("op10_exact_dedup", EXACT_SQL)
def q_exact(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents"))


A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op11_align_tokenizers")
def q_align(spark, sf):
    found, _ = alignment.align(table(spark, sf, "documents"), vocabulary_path(A_VOCABULARY), vocabulary_path(B_VOCABULARY))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def tiled(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The contract's words: in one document of ten, those from some word on repeat with a period."""
    if not words or doc_id is None or (h := zlib.crc32(doc_id.encode())) % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@register("op12_periodic_runs")
def q_periodic(spark, sf):
    found = periodic.periodic_runs(table(spark, sf, "documents"), prepare=tiled)
    rows = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(rows, lambda r: F.concat(r, F.lit("\n"))), "")
    order = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    found = found.withColumn("best", F.array_min(order))
    length, period = -F.col("best.l"), F.col("best.p")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@register("op13_sentencepiece")
def q_pieces(spark, sf):
    coded = pieces.encode_decode(table(spark, sf, "documents"), vocabulary_path(B_VOCABULARY))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")
