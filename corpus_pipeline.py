"""Corpus pipeline: language identification, near-duplicate removal, repeated
passages, secrets, packing. Every stage takes (spark, docs, sf_dir) and returns
a DataFrame that is written and read again as the next one's docs; all but the
last return the columns of documents.

Null texts: the first stage rejects documents without a letter, so they and
empty texts go there. Repeated rows of a document are one near-duplicate group.
Empty tables give empty tables. Columns beyond those of documents pass through
all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import language, packing, secrets, simhash, suffix_repeats
from vigil.llm.common import written

#: a passage of over 50 words begins at about 230 bytes, so the repeats stage
#: looks for strings of 200
PASSAGE_BYTES, PASSAGE_ANCHOR = 200, 48
#: language_id: share of texts with a language below the usual score, and how
#: much further below it a text is of no learned language
FAR_SHARE, FAR = 0.001, 0.1
#: rows with secrets whose spans may be broadcast
BROADCAST_ROWS = 50_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language. Those without a letter are rejected, and
    those as far from every profile as no text with a language is: a score more
    than FAR below that which all but FAR_SHARE of the texts with a language
    reach. A null ``lang`` becomes the predicted one. Profiles are learned from
    all rows with a language; where none has one, there is no profile to
    compare with and every text with a letter stays."""
    profiles = [tuple(r) for r in language.learn(docs).collect()]
    if not profiles:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    # predicted once, for the measure and for the choice
    known = written(language.predict(docs.withColumn("_text", F.col("text")), profiles, "_text",
                                     pred_col="_lang_pred", score_col="_score"), "predicted")
    known = known.where(F.col("_lang_pred") != language.UNKNOWN)
    usual = known.where("lang is not null").agg(F.percentile_approx("_score", FAR_SHARE, 10_000)).first()[0]
    new = {"lang": F.coalesce("lang", "_lang_pred")}
    return known.where(F.col("_score") >= (usual or 0.0) - FAR).select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id."""
    return simhash.deduplicate(docs).select(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of PASSAGE_BYTES bytes that stand earlier in
    the same or another text: of each passage the first copy, in order of
    (doc_id, place), stays. A character that a cut breaks goes too. n_chars
    follows the text."""
    # the other columns travel in one, so that none meets an output's name
    rest = F.struct(*[c for c in docs.columns if c not in ("text", "n_chars")]).alias("_doc")
    cut = suffix_repeats.remove_repeats(docs.select("doc_id", F.col("text").alias("_text"), rest), text_col="_text",
                                        length=PASSAGE_BYTES, anchor=PASSAGE_ANCHOR, kept_col="_kept", as_text=True,
                                        keep_first=True)
    new = {"text": F.col("_kept"), "n_chars": F.length("_kept").cast("long")}
    return cut.select(*[new.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with each secret replaced by a mark. n_chars follows the text."""
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    found = written(secrets.scan(keyed.select("_key", "text")).where(F.size("spans") > 0).dropDuplicates(["_key"])
                    .withColumnRenamed("spans", "_spans"), "secret-spans")
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(secrets.redact(F.col("text"), F.col("_spans")))
    return (keyed.join(found, "_key", "left").withColumn("text", text)
            .withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in sequences of at most 2048 tokens."""
    return packing.pack(packing.pieces(docs.select("doc_id", "text")))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("repeats", repeats),
          ("secret_scan", secret_scan), ("packing", pack)]
#: the stages are learned, hashed or tokenized, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
