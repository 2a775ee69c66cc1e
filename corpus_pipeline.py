"""Documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet to the shared folder and read again as the next stage's docs.
"""

from pyspark.sql import functions as F

from zonarium.llm import jaccard, langid, packing, suffix
from zonarium.llm.common import id_hash, stored


def language_id(spark, docs, sf_dir):
    """Documents whose language is recognised; those that language ID rejects go."""
    model = langid.fit(docs, id_hash("doc_id") % 4 != 2)
    found = langid.predict(docs, model, keep=docs.columns, prefix="__")
    return found.filter(~F.col("__rejected")).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies, the one of the least id."""
    return jaccard.keep_one(docs)


def repeated_passages(spark, docs, sf_dir):
    """Texts without the passages of over 50 words that also stand elsewhere; n_chars follows.

    A passage is made of repeated strings of 200 bytes; 51 words that have fewer bytes stay.
    """
    cut = suffix.remove_repeats(docs, length=suffix.PASSAGE_LENGTH, least_words=suffix.PASSAGE_WORDS)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed_sequences(spark, docs, sf_dir):
    """Place of every piece of a document in a training sequence."""
    return packing.pack_documents(docs, packing.word_count("text"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packed_sequences", packed_sequences),
]

#: Trained models, hashing and suffix arrays have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
