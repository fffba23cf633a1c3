"""From raw documents to encoded training data: one operator per stage, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetspark.llm.mixing import mixed
from fleetspark.llm.pieces import default_path, encode_pieces, load_vocabulary
from fleetspark.llm.quality import apply_quality_rules
from fleetspark.llm.simhash import keep_one
from fleetspark.llm.suffixes import without_repeats
from fleetspark.session import scratch_path

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that too many documents of their source share."""
    judged = apply_quality_rules(docs).where("kept").withColumn("text", F.col("clean_text"))
    return judged.withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked by three bits or fewer."""
    return keep_one(docs).select(*DOCUMENT)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start earlier; documents of which nothing is left go."""
    cut = without_repeats(docs).where("n_removed < n_bytes OR n_bytes = 0").withColumn("text", F.col("kept_text"))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*DOCUMENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixed(docs).select(*DOCUMENT)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and whether decoding them gives it back."""
    both = encode_pieces(docs, load_vocabulary(default_path()), read_back="decoded")
    same = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))
    return both.select("doc_id", "lang", "source", "n_chars", "pieces", "pieces_score", same.alias("round_trip"))


STAGES = [("quality rules", quality), ("simhash near-dedup", near_copies), ("suffix-array dedup", repeats),
          ("mixing", mix), ("piece encoding", encode)]

ORACLE_SQL = None  # later stages have no SQL form; tests compare them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
