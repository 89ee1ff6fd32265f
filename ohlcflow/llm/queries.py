"""Registered queries of the corpus operators: each applies its operator, with
production parameters, to its whole table and returns the whole result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import ANSWER_TOOL, as_tool_messages, link_tool_calls
from .decontam import contaminated
from .exact_dedup import exact_duplicates
from . import langid, toxicity
from .licenses import scan_licences
from .line_dedup import dedup_report
from .mixing import pareto_mix
from .nearest import nearest
from .ngram_join import ngram_components
from .periodic import periodic_runs
from .sharding import shard_documents
from .whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document's entire text, and of the notices among its lines."""
    out = scan_licences(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "canonical_digest", "license", F.array_join("notices", ",").alias("notices"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the rows that are not held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(F.coalesce(~held_out, F.lit(True))))
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    out = langid.identify(rows, model, spans=False)
    return out.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op3_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of near equal bytes; equal texts stay together."""
    narrow = _table(spark, sf_dir, "documents").select("doc_id", "text")
    # What the digest needs is taken before rows are dealt to their slots.
    out = shard_documents(narrow.select("doc_id", "text", F.crc32("text").alias("text_crc32")), n_shards=8)
    return out.select(
        "doc_id",
        F.col("shard_size").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat, nearly, an earlier line of the corpus."""
    return dedup_report(_table(spark, sf_dir, "documents"))


def op5_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's turns as calls and results, linked, ordered and checked."""
    messages = as_tool_messages(_table(spark, sf_dir, "conversations"))
    out = link_tool_calls(messages, {"answer": ANSWER_TOOL})
    return out.withColumn("errors", F.array_join("errors", "; "))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from the labels that are not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.train(docs, labels)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    out = toxicity.score_toxicity(rows, model, keep_text=False)
    score = F.col("toxicity")
    return out.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, verbatim or paraphrased."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, _table(spark, sf_dir, "benchmark"))


def op8_cuckoo_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document's normalised text; the smallest doc_id stays."""
    out = exact_duplicates(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("content")).alias("text_sha256")
    )


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, Jaccard 0.9: set size and component of every document."""
    return ngram_components(_table(spark, sf_dir, "documents"), shingle=3, percent=90, n2=3)


def op10_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words: 3, 1, 2 by source, 2 copies at most."""
    mix = pareto_mix(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_copies=2.0)
    return mix.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of every usable embedding. ``deviation`` is null
    where it is past a long's range."""
    out = whiten(_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with a periodic stretch in every text whose id's checksum ends in
    0: from word ``a`` on, the ``p`` words at ``a`` over and over. Other texts as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    word = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, word))
    n, g = F.size("words"), F.col("g")
    rows = rows.withColumn("a", F.when(n > 0, g % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    a, p = F.col("a").cast("int"), F.col("p").cast("int")
    repeated = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", a + (i - a) % p)))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every whole text, and the texts without the repeats."""
    out = periodic_runs(planted_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("l"), (-r.start).alias("s"), (-r.period).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    out = out.withColumn("best", best)
    length, period = F.col("best.l"), -F.col("best.p")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest embeddings of every row whose id is divisible by 20, among all rows."""
    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))
