"""The registered corpus queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kiosklake.llm import byte_bpe, chat, fingerprints, hard_negatives, language_id, mixing, near_dedup, oracles, periodic_runs, quality_rank, quality_rules, sentence_piece, token_counts, toxicity
from kiosklake.llm.common import fold_of, let, table, words

#: The rank file that ops 3 and 5 use; its first free id marks the end of a document.
RANKS, END_OF_DOCUMENT = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), 50256
#: The model file of op13.
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def _fold(folds: int, held_out: int):
    """Conditions on ``doc_id``: in the held-out fold, and in one of the others."""
    fold = fold_of(F.col("doc_id"), folds)
    return fold == held_out, fold != held_out


@query("op1_order_minhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classify(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out, learned = _fold(3, 1)
    model = language_id.train(docs, train_on=learned)
    return language_id.predict(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), RANKS, keep=["doc_id"])
    digests = coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        "ids", "ends",
    )
    decoded = byte_bpe.decode(digests, RANKS, keep=["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_perspective_chat", oracles.PERSPECTIVES)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return seen.select("conv_id", "speaker", "part", "n_turns", "rendered", F.array_join(spans, " ").alias("spans"))


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), RANKS, keep=["doc_id"])
    shards = token_counts.write_shards(coded, end=END_OF_DOCUMENT)
    counts = token_counts.count_tokens(shards.blocks, end=END_OF_DOCUMENT)
    return token_counts.with_ids(counts, shards.roster).select("doc_id", "n_tokens", "shard", "ordinal")


@query("op6_quality_rules", oracles.QUALITY_RULES)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"quality.{f}") for f in fields])


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out, learned = _fold(3, 1)
    lexicon = toxicity.train(docs, labels, train_on=learned)
    toxic = (F.col("score") >= toxicity.ACCEPT).cast("int")
    return toxicity.score(docs, lexicon, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", toxic.alias("predicted")
    )


@query("op8_quality_ranking")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out, learned = _fold(4, 2)
    model = quality_rank.train(docs, labels, train_on=learned)
    good = (F.col("score") >= quality_rank.ACCEPT).cast("int")
    return quality_rank.score(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", good.alias("predicted")
    )


@query("op9_weighted_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_neighbours(table(spark, sf_dir, "documents"))


@query("op10_temperature_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "_mix.n_tokens", "_mix.weight", "_mix.epoch", "_mix.block", "_mix.turn")


@query("op11_hard_negatives", oracles.HARD_NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return hard_negatives.mine(rows, asks=F.col("vec_id") % 100 == 0)


def _repeated(text: Column, doc_id: Column) -> Column:
    """The stated change of a tenth of the texts: from some word on, a few words over and over."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        often = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), often)), F.lit(1), n - a)
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")

    changed = let(words(F.coalesce(text, F.lit(""))), lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise(text))
    return F.when(h % 10 == 0, changed).otherwise(text)


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _repeated(F.col("text"), F.col("doc_id")).alias("text"))
    marked = periodic_runs.mark(docs, keep=["doc_id"]).withColumn("best", periodic_runs.strongest(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", *[r[f].cast("string") for f in periodic_runs.RUN.names]), F.lit("\n"))
    return marked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_sentence_piece")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentence_piece.encode(table(spark, sf_dir, "documents"), PIECES, keep=["doc_id"])
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    digests = coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"))
    decoded = sentence_piece.decode(digests, PIECES, keep=["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
