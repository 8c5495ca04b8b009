"""The registered queries of this subpackage: each operator over its whole table."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import audit, byte_bpe, chat, forest, jaccard, language, licenses, lm, mixture, prefix_trie, pseudonyms, quality, secrets
from .common import NO_ID, documents
from .turns import numbered, signature

#: The key of the registered pseudonym query and of the pipeline; a real run brings its own.
DEMO_KEY = "demonstration key"
#: The rank file of the registered queries; its place is a parameter of `byte_bpe.read_ranks`.
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    "n_lines_removed")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("found", lambda x: x["place"] < len(kinds))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    return d.select("doc_id", *[count(k).alias(f"n_{k}") for k in kinds],
                    F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("found")).alias("spans"))


def op4_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixture.mix(documents(spark, sf_dir).select("doc_id", "source", "text").select("doc_id", "source", mixture.words_of().alias("size")), size="size")
    return d.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text with personal data replaced, and how many values were replaced."""
    d = pseudonyms.pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), DEMO_KEY)
    n = F.aggregate(F.map_values("replaced"), F.lit(0), lambda a, x: a + x)
    return d.select("doc_id", "text", n.cast("long").alias("n_replaced"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no path: they are placed in one folder for each source and hundred of doc_id."""
    d = documents(spark, sf_dir).select("doc_id", "source", "text")
    d = d.select("doc_id", "text", F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.concat(
        F.lit("d"), F.floor(F.col("doc_id") / 100).cast("string")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"))
    return licenses.scan(d).select("doc_id", "path", "license", "license_score", "license_origin", "license_from")


def op2_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return forest.search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = language.identify(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return d.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
                    F.col("lang_rejected").alias("rejected"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_documents(documents(spark, sf_dir).select("doc_id", "text"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANKS))
    d = byte_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                    F.sha2(byte_bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir).select("doc_id", "text"))


#: The conversation that the chat query adds: both of its texts hold marks and escapes.
PLANTED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table holds finished messages: each becomes the log of a message that was streamed in pieces."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string"))
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = rows.select(F.coalesce(F.col("conv_id"), F.lit(NO_ID)).alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
                       signature(role, text).alias("sig"))
    return chat.read_back(chat.format_log(chat.events_of(numbered(rows))))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = prefix_trie.turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.trie(*prefix_trie.with_shared_starts(placed))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_hash_forest": op2_hash_forest,
    "op3_secret_scan": op3_secret_scan,
    "op4_source_mixture": op4_source_mixture,
    "op5_pseudonyms": op5_pseudonyms,
    "op6_language": op6_language,
    "op7_license_scan": op7_license_scan,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_lm_score": op10_lm_score,
    "op11_chat_format": op11_chat_format,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_filter_audit": op13_filter_audit,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from .sql import SQL

    return dict(SQL)
