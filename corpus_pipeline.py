"""From raw documents to token ids: toxicity, exact and near duplicates, mix, encoding.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but
the last return the columns of ``documents``. A stage that joins its choice back does so by a
key of each row, so rows that repeat an id or have none are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import exact_dedup, noisy_channel, piece_transducer, simhash_dedup, source_mix
from tallywork.llm.row_keys import KEY, with_row_keys
from tallywork.llm.text import importable, table
from tallywork.session import written

# The classifier, the seeded blocks and the encoder are beyond SQL; tests compare the rows
# with a plain version of each stage.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-channel classifier, trained on them, does not reject."""
    model = noisy_channel.train(docs, table(spark, sf_dir, "labels"))
    return noisy_channel.without_toxic(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id, one row of it."""
    return exact_dedup.without_duplicates(with_row_keys(docs), id=KEY).drop(KEY)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar fingerprints the one with the smallest id.

    Fingerprints are over shingles of three words and link at two bits, as in op9.
    """
    importable(spark)
    return simhash_dedup.without_near_duplicates(with_row_keys(docs, nulls_last=True), id=KEY).drop(KEY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a row for each time a document is taken, its
    text cut to the blocks taken."""
    importable(spark)
    rows = with_row_keys(docs)
    mixed = source_mix.mixed_documents(rows, source_mix.mix_sources(rows, id=KEY), id=KEY).drop(KEY)
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of the round trip."""
    importable(spark)
    return piece_transducer.encode_and_decode(docs, piece_transducer.read_vocabulary())


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("source mix", mix),
    ("SentencePiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
