"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from virotide.llm import alignment, chat, ctph, langid, linededup, mixing, packing, perplexity, phrases, sharding, simhash, suffixes, warc
from virotide.plans.registry import table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}
TOKENIZER_FILE = "word_bpe_49k.json"
ALIGNED_FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def add(function):
        LLM_QUERIES[name] = function
        if sql is not None:
            LLM_ORACLES[name] = sql
        return function

    return add


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


@query("op1_simhash")
def op1_simhash(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op2_suffixes")
def op2_suffixes(spark, sf_dir):
    out = suffixes.cut_repeats(table(spark, sf_dir, "documents"), least=200, keep_first=False)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op3_packing")
def op3_packing(spark, sf_dir):
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query("op4_chat")
def op4_chat(spark, sf_dir):
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.conversations(chat.chain(rows)))


@query("op5_langid")
def op5_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs.select("doc_id", "text"), langid.learn(docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")


@query("op6_warc")
def op6_warc(spark, sf_dir):
    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_ctph")
def op7_ctph(spark, sf_dir):
    return ctph.with_next(table(spark, sf_dir, "documents"))


@query("op8_mixing", mixing.ORACLE)
def op8_mixing(spark, sf_dir):
    return mixing.replicate(table(spark, sf_dir, "documents"))


@query("op9_linededup", linededup.ORACLE)
def op9_linededup(spark, sf_dir):
    return linededup.remove_repeats(table(spark, sf_dir, "documents"))


@query("op10_perplexity")
def op10_perplexity(spark, sf_dir):
    out = perplexity.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *perplexity.BASE, "base_failed", "kept", "log_ppl", "low", "high")


@query("op11_phrases", phrases.ORACLE)
def op11_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents")).drop("first")


@query("op12_alignment")
def op12_alignment(spark, sf_dir):
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in ALIGNED_FILES]
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


@query("op13_sharding")
def op13_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))
