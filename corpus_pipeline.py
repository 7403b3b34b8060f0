"""From raw documents to training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of
documents; every stage works on what its predecessor kept, and its result is written and read
again before the next one starts, so a lost executor costs a stage at most.

    toxicity               documents graded toxic go
    simhash_near_dedup     one document of each group of near copies stays, the smallest doc_id
    substring_dedup        passages that repeat earlier ones are cut from the texts
    decontamination        benchmark passages are cut from contaminated texts
    packing                the rest becomes sequences of at most 2,048 tokens

Every row is judged by its own text, also where rows share a doc_id or have none. Null texts
are empty ones; of several empty documents one stays. Tables need the five columns of documents;
others are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import decontam, packing, simhash, substrings, toxicity
from tidewatch.llm.common import read, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents graded toxic; the model is fitted on the labelled ones among these."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component, the one with the smallest doc_id; 4-word shingles, 4 bits."""
    return simhash.keep_one(docs.select(*COLUMNS), size=4, radius=4)


CARRIED = ["lang", "source"]


def _documents(texts: DataFrame) -> DataFrame:
    """Rows of an operator that gives new texts, as documents."""
    return texts.select("doc_id", "text", "carried.*", F.length("text").cast("long").alias("n_chars")).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts words that some 20-word window repeats from an earlier place."""
    return _documents(substrings.dedup(docs, window=20, carry=CARRIED))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts 13-word benchmark matches from texts of which they cover a twentieth."""
    found = decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"), window=13, share=20, carry=CARRIED)
    return _documents(found)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2,048 tokens."""
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048, end=1)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", cut_benchmark),
    ("packing", pack),
]

#: The stages call operators that SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; what one stage keeps is stored for the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
