"""Empty tables and extra columns with clashing names, for every operator that the other tests do not show them to; and the whole pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattline.llm import bpe, fingerprints, mixing, prefix_trie, queries, rule_quality, warc
from wattline.storage import scratch_path

from .conftest import CLASHING, SCHEMA, edge_rows, prose

VOCABULARY = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_empty_tables_give_empty_results(spark, no_docs):
    assert mixing.mix_sources(no_docs, queries.MIX_WEIGHTS, queries.MIX_SHARE, queries.MIX_CAP).collect() == []
    drawn = spark.createDataFrame([], "doc_id long, copies long")
    assert mixing.repeat_rows(no_docs, drawn).collect() == []
    assert bpe.encode_texts(no_docs, VOCABULARY).collect() == []
    assert fingerprints.fingerprint_texts(no_docs).collect() == []
    ensemble = rule_quality.fit_rules(no_docs.select(F.col("doc_id").alias("key"), "text", F.lit(1).alias("label")))
    assert rule_quality.score_quality(no_docs, ensemble).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_archives_of_pages_with_clashing_names(spark):
    rows = [(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200), (None, None, None), (3, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clashing = pages.select("*", *[F.lit("z").alias(c) for c in ("value", "owner", "payload_digest", "payload_bytes", "archive", "kind", "path", "record_type", "of_digest")])
    plain, found = (sorted(map(tuple, warc.archive_round_trip(p).collect()), key=repr) for p in (pages, clashing))
    assert found == plain and len(found) == 4


def folder_of(spark, docs, labels):
    path = scratch_path(spark, "pipeline-input")
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


LABELS = "doc_id long, quality int, toxic int"


def test_pipeline_of_an_empty_table(spark, no_docs):
    found = corpus_pipeline.run(spark, folder_of(spark, no_docs, spark.createDataFrame([], LABELS)))
    assert found.collect() == [] and "ids" in found.columns


def test_pipeline_equals_its_stages_by_hand(spark):
    """Every stage against a plain restatement of what it keeps, on rows with nulls, ties, long texts, copies and clashing names."""
    base = prose(70, 120).split()
    rows = [*edge_rows(), *((100 + i, prose(200 + i, 40 + i), "en", f"src{i % 3}", 1) for i in range(30))]
    rows += [(200 + i, " ".join([*base[:i], f"edit{i}", *base[i + 1 :]]), "en", "src1", 1) for i in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])
    labels = spark.createDataFrame([(100 + i, 1, 0) for i in range(30)], LABELS)
    path = folder_of(spark, docs, labels)
    kept = docs
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, path)
        place = scratch_path(spark, f"by-hand-{name}")
        kept.write.parquet(place)
        kept = spark.read.schema(kept.schema).parquet(place)
        counts.append((name, kept.count()))
        if name != "bpe":
            assert kept.columns == docs.columns
    texts = [t or "" for _, t, *_ in rows]
    # without a toxic label none goes; then one of each text stays; then one of each group of near copies
    distinct = set(texts)
    assert counts[0][1] == len(rows) and counts[1][1] == len(distinct)
    from .test_dedup import near_expected

    _, groups = near_expected([(k, t, None, None, None) for k, t in enumerate(sorted(distinct))])
    assert counts[2][1] == groups
    whole = corpus_pipeline.run(spark, path)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, kept.collect())) and whole.count() == counts[3][1]
