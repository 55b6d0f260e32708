"""The corpus pipeline: toxic documents go, exact and near copies go, sources are mixed, and the mix is encoded.

Each stage takes (spark, docs, sf_dir), works on every row it is given, and returns a DataFrame that is written and read
again as the next stage's documents. All stages but the last return the columns of ``documents``.

Nulls and empty texts are documents like others: an empty text has the score of the model's intercept, equals other
empty texts, links with nothing, has size 0 and so is not drawn into the mix. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bpe, exact_dedup, jaccard_join, mixing, queries, toxicity
from wattline.storage import materialize

#: No SQL: the first stage is a fitted classifier.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from all labelled rows among them that are not held out."""
    labels = queries.table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(queries.labelled(docs, labels, "toxic", 3, 1))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.exact_dedup(docs, keep="largest").where("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    return jaccard_join.near_dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them."""
    drawn = mixing.mix_sources(docs, queries.MIX_WEIGHTS, queries.MIX_SHARE, queries.MIX_CAP)
    return mixing.repeat_rows(docs, drawn)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and the digests that prove the round trip."""
    import public_tokenizers

    encoded = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=False)
    return encoded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
