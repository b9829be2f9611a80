"""Registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respengine.llm import byte_cnn
from respengine.llm.chat_format import chat_format, read_back
from respengine.llm.common import read_table, shared_path, stored
from respengine.llm.conversation_trie import placed_turns, prefix_trie
from respengine.llm.decontaminate import contaminated
from respengine.llm.exact_dedup import exact_dedup
from respengine.llm.jaccard_join import jaccard_components
from respengine.llm.language_id import identify, learn, remainder
from respengine.llm.lm_score import lm_score
from respengine.llm.merkle_manifest import COLUMNS, fold, leaf_hash, manifest
from respengine.llm.mixing import mix
from respengine.llm.secret_scan import listed, scan
from respengine.llm.substring_dedup import substring_dedup
from respengine.llm.suffix_dedup import suffix_dedup
from respengine.operators.joins import hot_threshold, lookup_join


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 200-byte strings, removed from every document."""
    docs = read_table(spark, sf_dir, "documents")
    return suffix_dedup(docs, width=200, keep_text=False).drop("kept")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document; a quarter of them is held out."""
    docs = read_table(spark, sf_dir, "documents")
    profiles = learn(docs.where(remainder("doc_id", 4) != 2))
    told = docs.select("doc_id", "text", (remainder("doc_id", 4) == 2).alias("held_out"))
    return identify(told, profiles).drop("text")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code length of every document; a tenth of them is held out."""
    docs = read_table(spark, sf_dir, "documents")
    out = remainder("doc_id", 10) == 0
    return lm_score(docs, ~out).withColumn("held_out", out)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a new ledger."""
    found = scan(read_table(spark, sf_dir, "documents"), shared_path(spark, "secret_ledger"))
    kind = lambda k: F.size(F.filter("f", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    rows = found.withColumn("f", F.coalesce("findings", F.array().cast(found.schema["findings"].dataType)))
    return rows.select("doc_id", kind("assign"), kind("access"), kind("hex"),
                       F.sha2(listed(F.filter("f", lambda s: s["base"])), 256).alias("base_sha256"),
                       listed(F.col("f")).alias("spans"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    extra = spark.sql(f"""select * from values (-1L, 0L, 'user', '{CONTROL_TEXT}'),
        (-1L, 1L, 'assistant', '{CONTROL_TEXT}') as t(conv_id, turn, role, text)""")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = read_back(chat_format(turns.unionAll(extra)))
    said = F.flatten(F.transform("blocks", lambda b: F.transform(
        b["texts"], lambda t: F.concat(b["role"], F.lit("\n"), t, F.lit("\n")))))
    learned = F.array_join(F.flatten(F.transform(
        F.filter("blocks", lambda b: b["trained"]), lambda b: b["texts"])), "")
    return back.select("conv_id", F.size(said).cast("long").alias("n_turns"),
                       F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"),
                       F.sha2(learned, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mix(read_table(spark, sf_dir, "documents")).drop("source")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the near-duplicate component it belongs to."""
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of repeated 35-word windows, removed from every document."""
    docs = read_table(spark, sf_dir, "documents")
    return substring_dedup(docs, window=35, keep_text=False).drop("kept")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, and the window that does."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays."""
    return exact_dedup(read_table(spark, sf_dir, "documents")).drop("file", "pos")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every document, and the root it gives after some documents were changed."""
    docs = read_table(spark, sf_dir, "documents")
    changed = F.col("doc_id").isNotNull() & F.col("n_chars").isNotNull() & (remainder("doc_id", 7) == 0)
    values = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    made = manifest(docs, tampered=F.when(changed, leaf_hash(*values)))
    return made.proofs().select(
        "doc_id", "leaf", "subroot", F.lit(made.root).cast("string").alias("root"),
        F.sha2("siblings", 256).alias("proof_sha256"),
        fold(F.coalesce("tampered", "leaf"), F.col("siblings"), F.col("sides")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))


def _rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns (up to 3) taken from another one; and the
    conversations that this leaves without turns."""
    placed, groups = placed_turns(conversations)
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    heads = placed.where("pos < 3").groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "id", "words"))).alias("t"))
    convs = groups.withColumn("h", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % 20)
    first = F.coalesce(F.slice("t", 1, F.col("h").cast("int")), F.array().cast(heads.schema["t"].dataType))
    convs = convs.join(heads, "base", "left").withColumn("t", first) \
        .withColumn("total", F.size("t") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "n", "h", "t", "total"), "trie/rebuilt")
    taken = convs.select("conv_id", F.inline("t"), "total") \
        .select("conv_id", F.col("pos").alias("at"), "total", "id", "words")
    fewer = convs.select("conv_id", (F.col("h") - F.size("t")).alias("missing")).where("missing > 0")
    total, most = convs.agg(F.sum("n"), F.count("*")).first()
    crowd = convs.where(F.col("n") >= hot_threshold(total or 0)).select("conv_id")
    own = lookup_join(placed.withColumn("h", head).where("pos >= h"), fewer, ["conv_id"], table_rows=most,
                      hot_keys=crowd, max_broadcast_rows=100_000)
    less = F.coalesce("missing", F.lit(0))
    kept = own.select("conv_id", (F.col("pos") - less).alias("at"), (F.col("n") - less).alias("total"), "id", "words")
    return taken.unionAll(kept), convs.where("total = 0").select("conv_id")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct sequence of first turns of the rebuilt conversations."""
    turns, turnless = _rebuilt(read_table(spark, sf_dir, "conversations"))
    return prefix_trie(turns, turnless).drop("turn_id")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document; a fifth of the labels is held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    network = byte_cnn.learn(docs, labels.where(remainder("doc_id", 5) != 0))
    told = docs.select("doc_id", "text", (remainder("doc_id", 5) == 0).alias("held_out"))
    return byte_cnn.classify(told, network).drop("text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_language_id, op3_lm_score, op4_secret_scan,
                             op5_chat_format, op6_mix_sources, op7_ngram_jaccard_join, op8_substring_dedup,
                             op9_decontaminate, op10_exact_dedup, op11_merkle_manifest, op12_conversation_trie, op13_quality_classifier)}
