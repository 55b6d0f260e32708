"""Substring deduplication with compressed FM-indexes, one per shard.

A window is a fixed number of consecutive words. Comparing every document with every shard would be quadratic, so
shards are made by content: each window has a minimizer, the smallest hash among its short word sequences, and equal windows have
equal minimizers. A run of windows with one minimizer is a segment. Only segments whose minimizer occurs again can hold a
repeated window; equal segments are combined where they are read, and the distinct ones go to shards by minimizer. Each shard is indexed, its
segments stream through backward search, and the matching statistics say which windows occur elsewhere. The
work is linear in the words.

A minimizer with more words than a shard may hold is dealt by whole windows instead, each by its own hash, so a common
passage in many contexts never makes one shard large.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import pieces, text_bytes
from wattline.llm.fm_index import ShardIndex
from wattline.llm.words import gram_hashes, span_hashes, word_spans
from wattline.storage import materialize

WINDOW = 35
#: Words of the sequences that minimizers are taken from.
SEED_WORDS = 8
#: Words that one index holds, about.
SHARD_WORDS = 1_000_000


def window_runs(words: np.ndarray, first: np.ndarray, window: int, seed: int):
    """Runs of windows with one minimizer: text, first word in the text, windows, minimizer, whether it may repeat inside."""
    none = np.empty(0, np.int64)
    grams = gram_hashes(words, seed)
    width = window - seed + 1
    if len(grams) < width:
        return none, none, none, np.empty(0, np.uint64), np.empty(0, bool)
    levels = {1: (grams, np.zeros(len(grams), bool))}

    def joined(a, b, shift):
        (x, tie_x), (y, tie_y) = a, b
        n = len(y) - shift
        x, tie_x, y, tie_y = x[:n], tie_x[:n], y[shift:], tie_y[shift:]
        left = x < y
        return np.where(left, x, y), np.where(left, tie_x, tie_y) | (x == y)

    span = 1
    while span * 2 <= width:
        levels[span * 2] = joined(levels[span], levels[span], span)
        span *= 2
    best, done = levels[span], span
    for part in (p for p in sorted(levels, reverse=True) if p < span):
        if done + part <= width:
            best, done = joined(best, levels[part], done), done + part
    least, tie = best
    counts = np.maximum(np.diff(first) - window + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = first[:-1][owner] + inner
    if not len(at):
        return none, none, none, np.empty(0, np.uint64), np.empty(0, bool)
    least, tie = least[at], tie[at]
    begins = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])])
    many = np.diff(np.r_[begins, len(at)])
    # without a tie the minimizer's places are at least `width` apart, and so are equal windows: they need a longer run than that
    return owner[begins], inner[begins], many, least[begins], np.logical_or.reduceat(tie, begins) | (many > width)


def _runs(docs: DataFrame, window: int, seed: int) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "text"):
                raw, borders = text_bytes(piece.column("text"))
                starts, ends, first = word_spans(raw, borders)
                of, begin, many, least, tie = window_runs(span_hashes(raw, starts, ends), first, window, seed)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").take(pa.array(of)), piece.column("text_hash").take(pa.array(of)), pa.array(begin.astype(np.int32)),
                     pa.array(many.astype(np.int32)), pa.array(least.view(np.int64)), pa.array(tie)],
                    ["id", "text_hash", "begin", "many", "least", "tie"],
                )

    return docs.mapInArrow(run, f"id {kind}, text_hash long, begin int, many int, least long, tie boolean")


def _with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Every document with its runs; without runs its result is final and its text is no longer needed."""
    kind = docs.schema["id"].dataType.simpleString()
    listed = runs.groupBy("id", "text_hash").agg(F.collect_set(F.struct("begin", "many", "least")).alias("runs"))
    listed = listed.select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_hash"), "runs")
    met = docs.join(listed, (F.col("text_hash") == F.col("of_hash")) & F.col("id").eqNullSafe(F.col("of_id")), "left").drop("of_id", "of_hash")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "text"):
                counts, sums, texts = [], [], []
                for text, own in zip(piece.column("text").to_pylist(), piece.column("runs").is_valid().to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    counts.append(len(words))
                    sums.append(None if own else hashlib.sha256(b" ".join(words)).hexdigest())
                    texts.append(text if own else None)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("text_hash"), pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string()), piece.column("runs")],
                    ["id", "text_hash", "n_words", "kept_sha256", "text", "runs"],
                )

    runs_type = "array<struct<begin:int,many:int,least:long>>"
    return met.mapInArrow(run, f"id {kind}, text_hash long, n_words long, kept_sha256 string, text string, runs {runs_type}")


def _places(held: DataFrame, window: int) -> DataFrame:
    """Where each segment is: id, text_hash, begin, least, content_hash, words."""
    found = _segments(held, window)
    words = F.length("content") - F.length(F.translate("content", " ", "")) + 1
    return found.select("id", "text_hash", "begin", "least", F.xxhash64("content").alias("content_hash"), words.alias("words"))


def _combined(segments: DataFrame) -> DataFrame:
    """Distinct segments with their copies: least, content, copies.

    Copies are combined in each batch, so a passage with very many copies is a few rows when it moves. The rows move once, by
    minimizer; the aggregation and the index both find them in place.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "content", 4 << 20):
                counts = pa.Table.from_batches([piece]).group_by(["least", "content"]).aggregate([("content", "count")])
                for part in counts.select(["least", "content", "content_count"]).to_batches():
                    yield pa.RecordBatch.from_arrays(part.columns, ["least", "content", "copies"])

    combined = segments.select("least", "content").mapInArrow(run, "least long, content string, copies long")
    return combined.repartition("least").groupBy("least", "content").agg(F.sum("copies").alias("copies"))


def _segments(held: DataFrame, window: int) -> DataFrame:
    """The segments of all runs: id, text_hash, begin, least, content (words joined by one space)."""
    kind = held.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "text", 1 << 19):
                at, begins, leasts, contents = [], [], [], []
                for k, (text, runs) in enumerate(zip(piece.column("text").to_pylist(), piece.column("runs").to_pylist(), strict=True)):
                    words = text.encode().split()
                    for r in runs:
                        at.append(k)
                        begins.append(r["begin"])
                        leasts.append(r["least"])
                        contents.append(b" ".join(words[r["begin"] : r["begin"] + r["many"] + window - 1]))
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").take(take), piece.column("text_hash").take(take), pa.array(begins, pa.int32()), pa.array(leasts, pa.int64()),
                     pa.array(contents, pa.binary()).cast(pa.string())],
                    ["id", "text_hash", "begin", "least", "content"],
                )

    return held.select("id", "text_hash", "text", "runs").mapInArrow(run, f"id {kind}, text_hash long, begin int, least long, content string")


def _single_windows(segments: DataFrame, window: int) -> DataFrame:
    """Segments cut into their windows; the hash of the window stands for the minimizer."""
    kind = segments.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "content", 1 << 17):
                at, begins, contents = [], [], []
                for k, (begin, content) in enumerate(zip(piece.column("begin").to_pylist(), piece.column("content").to_pylist(), strict=True)):
                    words = content.encode().split()
                    for j in range(len(words) - window + 1):
                        at.append(k)
                        begins.append(begin + j)
                        contents.append(b" ".join(words[j : j + window]))
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").take(take), piece.column("text_hash").take(take), pa.array(begins, pa.int32()), pa.array(contents, pa.binary()).cast(pa.string())],
                    ["id", "text_hash", "begin", "content"],
                )

    cut = segments.select("id", "text_hash", "begin", "content").mapInArrow(run, f"id {kind}, text_hash long, begin int, content string")
    return cut.select("id", "text_hash", "begin", F.xxhash64("content").alias("least"), "content")


def _index_shards(distinct: DataFrame, window: int, shard_words: int) -> DataFrame:
    """Ranges of repeated windows of every distinct segment (least, content, copies)."""

    def results(rows):
        words, lengths, copies = [], [], []
        numbers: dict[bytes, int] = {}
        for _, content, n in rows:
            own = content.encode().split()
            words.extend([numbers.setdefault(w, len(numbers) + 1) for w in own])
            lengths.append(len(own))
            copies.append(n)
        index = ShardIndex(np.array(words, np.int64), np.array(lengths, np.int64), np.array(copies, np.int64), window)
        found = index.repeated()
        for k, start in enumerate(index.starts):
            own = found[start : start + lengths[k] - window + 1]
            if own.any():
                edges = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
                yield rows[k][0], rows[k][1], [{"low": int(a), "high": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("least", pa.int64()), ("content", pa.string()), ("ranges", pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))])

        def flush(rows):
            out = list(zip(*results(rows), strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types, strict=True)], schema=schema)

        rows, held = [], 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("least", "content", "copies")], strict=True):
                # a minimizer is never cut in two
                if held >= shard_words and row[0] != rows[-1][0]:
                    yield flush(rows)
                    rows, held = [], 0
                rows.append(row)
                held += row[1].count(" ") + 1
        if rows:
            yield flush(rows)

    out = distinct.sortWithinPartitions("least").mapInArrow(run, "least long, content string, ranges array<struct<low:int,high:int>>")
    return out.select("least", F.xxhash64("content").alias("content_hash"), "ranges")


def _remove(held: DataFrame, cuts: DataFrame, window: int) -> DataFrame:
    kind = held.schema["id"].dataType.simpleString()
    listed = cuts.groupBy("id", "text_hash").agg(F.collect_set(F.struct("low", "high")).alias("cuts"))
    listed = listed.select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_hash"), "cuts")
    met = held.join(listed, (F.col("text_hash") == F.col("of_hash")) & F.col("id").eqNullSafe(F.col("of_id")), "left")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "text"):
                removed, kept, spans = [], [], []
                for text, cut in zip(piece.column("text").to_pylist(), piece.column("cuts").to_pylist(), strict=True):
                    words = text.encode().split()
                    change = np.zeros(len(words) + 1, np.int32)
                    for c in cut or ():
                        change[c["low"]] += 1
                        change[c["high"] + window - 1] -= 1
                    stay = np.cumsum(change[:-1]) == 0
                    removed.append(int((~stay).sum()))
                    kept.append(b" ".join([w for w, s in zip(words, stay.tolist(), strict=True) if s]))
                    edges = np.flatnonzero(np.diff(np.r_[False, ~stay, False].astype(np.int8)))
                    spans.append([{"low": int(a), "high": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
                sums = [hashlib.sha256(k).hexdigest() for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("n_words"), pa.array(removed, pa.int64()), pa.array(sums, pa.string()),
                     pa.array(spans, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())])))],
                    ["id", "n_words", "n_removed", "kept_sha256", "removed"],
                )

    schema = f"id {kind}, n_words long, n_removed long, kept_sha256 string, removed array<struct<low:int,high:int>>"
    return met.select("id", "n_words", "text", "cuts").mapInArrow(run, schema)


def substring_dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, seed: int = SEED_WORDS, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``removed``, the word ranges that go.

    A word goes if a window over it starts a second time anywhere, in the same document included. Null and empty texts have no
    word; texts shorter than a window keep everything; the kept words of a text without any are the empty string. Repeated rows
    are documents of their own, so each repeats the other. Null keys stay. An empty table gives an empty result.
    """
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    runs = materialize(_runs(source, window, seed), "runs")
    again = runs.groupBy("least").agg(F.count(F.lit(1)).alias("n"), F.max("tie").alias("tie")).where("n > 1 or tie").select("least")
    held = materialize(_with_runs(source, runs.join(again, "least", "left_semi")), "held")
    open_ = held.where(F.col("text").isNotNull())
    segments = _segments(open_, window)
    places = materialize(_places(open_, window), "places")
    # distinct segments of a minimizer, counted by hash: only their sizes matter here
    large = places.groupBy("least", "content_hash").agg(F.first("words").alias("words"))
    large = large.groupBy("least").agg(F.sum("words").alias("words")).where(F.col("words") > shard_words).select("least")
    large = materialize(large, "large")
    crowded = large.count()
    usual = segments.join(large, "least", "left_anti") if crowded else segments
    found = _index_shards(_combined(usual), window, shard_words)

    def cuts(found: DataFrame, where: DataFrame) -> DataFrame:
        met = where.join(found, ["least", "content_hash"]).select("id", "text_hash", "begin", F.explode("ranges").alias("r"))
        return met.select("id", "text_hash", (F.col("begin") + F.col("r.low")).alias("low"), (F.col("begin") + F.col("r.high")).alias("high"))

    all_cuts = cuts(found, places)
    if crowded:
        single = _single_windows(segments.join(large, "least", "left_semi"), window)
        where = single.select("id", "text_hash", "begin", "least", F.xxhash64("content").alias("content_hash"))
        all_cuts = all_cuts.union(cuts(_index_shards(_combined(single), window, shard_words), where))
    changed = _remove(open_, all_cuts, window)
    none = F.array().cast("array<struct<low:int,high:int>>")
    same = held.where(F.col("text").isNull()).select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", none.alias("removed"))
    return same.union(changed).withColumnRenamed("id", "doc_id")
