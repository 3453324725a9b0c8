"""Training tokens from raw documents: select, clean, deduplicate, decontaminate, encode.

Each stage gets what the one before it kept, written as Parquet and read again. Null and
empty texts pass every stage (as near-duplicates of each other they are one group); null
ids are kept; rows are judged one by one, so repeated rows and ties need no care but where
a stage says so; empty tables give empty ones, and empty labels or benchmarks change nothing.
Stages lower the session's rows per Parquet batch: the texts of a batch lie in one array on the heap.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm import bpe, decontaminate, line_dedup, quality, simhash
from stationflow.llm.common import small_reads
from stationflow.session import scratch_path

#: Tail probability of the top grade from which a document stays.
SELECT_AT = 0.5
#: Near-duplicates: sets of shingles of five words with a Jaccard similarity of at least 4/5.
WORDS, SIMILARITY = 5, (4, 5)
#: Candidates: four lanes of 64 bits, at most 76 of 256 differ. Of sets with that similarity
#: 48 differ at most on average (four shingles of five), 6.3 standard deviation.
LANES, RADIUS = 4, 76

#: Words of a benchmark passage that tell it from chance; op5's windows are as long.
PASSAGE = 10
_WORDS = "[0-9A-Za-z[^\\x00-\\x7F]]+"


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier expects to be good; the others, toxic ones included, go.

    Labels with nulls do not count, of repeated ones the lowest grade does. Without two
    different grades among them nothing goes.
    """
    small_reads(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, quality.grade_of(labels))
    return quality.grade(docs, model).where(F.col("p_good") >= SELECT_AT).select(docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many share; ``n_chars`` follows the text.

    Lines stay in the document with the greatest id that holds them, in all rows of that id. A
    null text becomes the empty one.
    """
    small_reads(spark)
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.

    A null id is greater than others; of rows alike in id and text one stays.
    """
    small_reads(spark)
    return simhash.keep_one(docs, WORDS, RADIUS, LANES, simhash.MINIMA, similarity=SIMILARITY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; ``n_chars`` follows the text.

    An item of fewer than ``PASSAGE`` words is met by chance: its words are cut, and a
    document goes only if nothing else was in it. Items without a text find nothing.
    """
    small_reads(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    long = F.regexp_count("text", F.lit(_WORDS)) >= PASSAGE
    kept = decontaminate.mark(docs, benchmark.where(long), PASSAGE).where(~F.col("contaminated")).select(docs.columns)
    short = benchmark.where(~long)
    if short.isEmpty():
        return kept
    cut = decontaminate.mark(kept, short, PASSAGE, remove_spans=True).where(~F.col("contaminated") | (F.col("n_hit") < F.col("n_words")))
    size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.when(F.col("contaminated"), size).otherwise(F.col("n_chars"))).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of each text; ``round_trip`` says that they decode to the text.

    A null text has no tokens and decodes to the empty text.
    """
    small_reads(spark)
    vocabulary = bpe.read_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    decoded = bpe.decode(bpe.encode(docs, vocabulary), vocabulary)
    same = F.encode(F.coalesce("text", F.lit("")), "UTF-8") == F.col("decoded")
    return decoded.select("doc_id", "lang", "source", "n_tokens", "tokens", same.alias("round_trip"))


STAGES = [
    ("quality classifier", select_quality),
    ("line dedup", drop_shared_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level bpe", encode_tokens),
]

# The classifier and fingerprints are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
