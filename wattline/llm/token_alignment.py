"""Alignment of two tokenizers' tokens over the same bytes, as an Arrow pipeline.

Both tokenizers cut the bytes of a text into tokens. Where tokens of both end at the same byte the text is cut into groups, and a token of
the one is linked with all tokens of the other in its group. A task lays the tokens of many texts out flat (list flatten and parent
indices), finds their ends by cumulative sums of token widths within each text, joins the ends of both sides on (document, end) in Acero, and joins
the tokens of a group likewise. Links are kept per document as distinct id pairs with their number; ``Table.group_by`` counts in how many
documents of a task a pair is linked, and Spark adds these counts up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import pieces
from wattline.llm.bpe import PATTERN, byte_symbols
from wattline.storage import materialize, scratch_path

#: Bytes of text that are laid out flat together; a longer text is taken alone.
TEXT_BYTES = 1 << 20
#: Pairs that are expanded, or counted in a task before they are sent on, at a time.
PAIRS_AT_ONCE = 1 << 20
#: Most counted pairs that go to every task (12 bytes each). The rarer ones beyond are joined instead.
MOST_PAIRS = 2_000_000


KEPT = ("rid", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
SCORED = "n_best long, count_sum long, rest array<long>, rest_links array<long>"


class ByteTokenizer:
    """A byte-level BPE file of the tokenizers library; special tokens inside texts are plain text."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, split = told["model"], told["pre_tokenizer"]
        if model["type"] != "BPE" or told["normalizer"] or split != split | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            raise ValueError(f"{path} is no plain byte-level BPE vocabulary")
        to_byte = byte_symbols()
        special = {t["content"] for t in told["added_tokens"]}
        ids = {bytes(map(to_byte.__getitem__, s)): i for s, i in model["vocab"].items() if s not in special}
        merged = [ids[bytes(to_byte[c] for c in "".join(pair if isinstance(pair, list) else pair.split(" ")))] for pair in model["merges"]]
        if merged != sorted(merged) or len(set(merged)) < len(merged):
            raise ValueError(f"{path} has ids that are not in the order of its merges")
        self.path, self.encoding = path, tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
        self.bytes_of = {i: b for b, i in ids.items()}
        self.library = None

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._one(" " + text) for text in texts]

    def _one(self, text: str) -> list[int]:
        try:
            return self.encoding.encode_ordinary(text)
        except BaseException as error:  # its pattern matcher gives up on very long runs, with an error of its own outside Exception
            if not isinstance(error, Exception) and type(error).__name__ != "PanicException":
                raise
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
                self.library.encode_special_tokens = True
            return self.library.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """A sentencepiece model, which puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = {
            i: bytes([int(name[3:-1], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)
        }

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


class Side:
    """One tokenizer with its ids' bytes, widths and digits as Arrow arrays."""

    def __init__(self, tokenizer):
        import pyarrow as pa

        self.encode = tokenizer.encode
        self.width = max(tokenizer.bytes_of, default=0) + 1
        parts = [tokenizer.bytes_of.get(i, b"") for i in range(self.width)]
        self.bytes = pa.array(parts, pa.large_binary())
        self.sizes = pa.array(list(map(len, parts)), pa.int64())
        self.digits = pa.array(list(map(str, range(self.width))), pa.large_string())


def _lists(rows: list[list[int]]):
    import pyarrow as pa

    borders = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=borders[1:])
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(borders[-1]))
    return pa.LargeListArray.from_arrays(pa.array(borders), pa.array(flat))


def _joined(lists, parts):
    """The parts of each list's ids, end to end."""
    import pyarrow as pa
    import pyarrow.compute as pc

    return pc.binary_join(pa.LargeListArray.from_arrays(lists.offsets, pc.take(parts, lists.flatten())), pa.scalar(b"", pa.large_binary()))


def _tokens(lists, side: Side):
    """A table of all tokens in order: document, place, byte behind the token in its document, id."""
    import pyarrow as pa
    import pyarrow.compute as pc

    doc, ids = pc.list_parent_indices(lists), pc.list_flatten(lists)
    upto = pc.cumulative_sum(pc.take(side.sizes, ids))
    before = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), upto]), lists.offsets.slice(0, len(lists)))
    return pa.table({"doc": doc, "end": pc.subtract(upto, pc.take(before, doc)), "at": pa.array(np.arange(len(ids))), "id": ids})


def _group_sizes(tokens, cuts: np.ndarray):
    """How often each id stands in each group: ``group``, ``id``, ``n``. A group ends at each place of ``cuts``."""
    import pyarrow as pa

    ends = np.zeros(len(tokens), np.int64)
    ends[cuts] = 1
    groups = np.cumsum(ends) - ends
    keyed = pa.table({"group": pa.array(groups), "id": tokens["id"]})
    return keyed.group_by(["group", "id"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", "id", "n"])


def _link_pairs(a_sizes, b_sizes, doc_of_group: np.ndarray, a_width: int, b_width: int):
    """Distinct id pairs per document with their number of links: ``key`` (document, a, b in one number, ascending) and ``links``."""
    import pyarrow as pa
    import pyarrow.compute as pc

    b_rows = np.bincount(b_sizes["group"].to_numpy(), minlength=len(doc_of_group))
    upto = np.cumsum(b_rows[a_sizes["group"].to_numpy()])
    found, begin = [], 0
    while begin < len(a_sizes):
        # slices of the one side whose expansion is bounded; one row has at most a group's distinct ids of the other
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS_AT_ONCE, "right")))
        met = a_sizes.slice(begin, end - begin).join(b_sizes, "group", join_type="inner", right_suffix="_b", use_threads=False)
        doc = pc.take(pa.array(doc_of_group), met["group"])
        key = pc.add(pc.multiply(pc.add(pc.multiply(doc, a_width), met["id"].cast(pa.int64())), b_width), met["id_b"].cast(pa.int64()))
        part = pa.table({"key": key, "links": pc.multiply(met["n"], met["n_b"])})
        found.append(part.group_by("key", use_threads=False).aggregate([("links", "sum")]).rename_columns(["key", "links"]))
        begin = end
    if not found:
        return pa.table({"key": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
    if len(found) > 1:
        found = [pa.concat_tables(found).group_by("key", use_threads=False).aggregate([("links", "sum")]).rename_columns(["key", "links"])]
    return found[0].sort_by("key")


def align(texts: list[str | None], a_side: Side, b_side: Side) -> dict:
    """Arrow arrays with one value per text: see `align_texts` and `_aligned`."""
    import pyarrow as pa
    import pyarrow.compute as pc

    some = [k for k, t in enumerate(texts) if t]
    filled = [texts[k] for k in some]
    wanted = pa.array([b" " + t.encode() for t in filled], pa.large_binary())
    sides, lists, valid = (a_side, b_side), [], np.ones(len(filled), bool)
    for side in sides:
        lists.append(_lists(side.encode(filled)))
        valid &= pc.equal(_joined(lists[-1], side.bytes), wanted).to_numpy(zero_copy_only=False)
    # texts that a tokenizer does not give back have no tokens
    kept = [k for k, ok in zip(some, valid.tolist(), strict=True) if ok]
    lists = [side_lists.filter(pa.array(valid)) for side_lists in lists]
    a, b = (_tokens(side_lists, side) for side_lists, side in zip(lists, sides, strict=True))
    ends = a.select(["doc", "end", "at"]).join(b.select(["doc", "end", "at"]), ["doc", "end"], join_type="inner", right_suffix="_b", use_threads=False)
    ends = ends.sort_by("at")
    cuts_a, cuts_b, doc = ends["at"].to_numpy(), ends["at_b"].to_numpy(), ends["doc"].to_numpy().astype(np.int64)
    n_groups = np.bincount(doc, minlength=len(kept))
    a_sizes, b_sizes = _group_sizes(a, cuts_a), _group_sizes(b, cuts_b)
    pairs = _link_pairs(a_sizes, b_sizes, doc, a_side.width, b_side.width)
    key, links = pairs["key"].to_numpy(), pairs["links"].to_numpy()
    pair_doc, pair = np.divmod(key, a_side.width * b_side.width)
    written = []
    for tokens, cuts, side in ((a, cuts_a, a_side), (b, cuts_b, b_side)):
        borders = pa.array(np.r_[0, cuts + 1])
        written.append(pc.binary_join(pa.LargeListArray.from_arrays(borders, pc.take(side.digits, tokens["id"].combine_chunks())), pa.scalar(",", pa.large_string())))
    both = pc.binary_join_element_wise(*written, pa.scalar("|", pa.large_string()))
    group_borders = np.r_[0, np.cumsum(n_groups)]
    groups = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(group_borders), both), pa.scalar(";", pa.large_string()))

    def place(values, empty=0):
        out = np.full(len(texts), empty, np.int64)
        out[kept] = values
        return out

    pair_borders = np.r_[0, np.cumsum(place(np.bincount(pair_doc, minlength=len(kept))))].astype(np.int32)
    written_of = dict(zip(kept, groups, strict=True))
    total = np.r_[0, np.cumsum(links)]
    firsts = np.searchsorted(pair_doc, np.arange(len(kept) + 1))
    return {
        "n_a": place(np.diff(lists[0].offsets.to_numpy())), "n_b": place(np.diff(lists[1].offsets.to_numpy())), "n_groups": place(n_groups),
        "n_links": place(total[firsts[1:]] - total[firsts[:-1]]), "groups": [written_of[k].as_py() if k in written_of else "" for k in range(len(texts))],
        "pairs": pa.ListArray.from_arrays(pa.array(pair_borders), pa.array(pair)), "links": pa.ListArray.from_arrays(pa.array(pair_borders), pa.array(links)),
    }


def _aligned(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool) -> DataFrame:
    """One written row per document (key, text), numbered by ``rid``: counts, groups and their digest, distinct ``pairs`` (a * width of b + b, ascending) and their ``links``."""
    key_type = docs.schema["key"].dataType.simpleString()

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        a_side, b_side = Side(ByteTokenizer(a_path)), Side(PieceTokenizer(b_path))
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in pieces(batch, "text", TEXT_BYTES):
                found = align(piece.column("text").to_pylist(), a_side, b_side)
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
                shown = found["groups"] if keep_groups else [None] * len(digests)
                rids = np.arange(rid, rid + len(digests))
                rid += len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rids), piece.column("key"), *(pa.array(found[c]) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(digests, pa.string()),
                     pa.array(shown, pa.string()), found["pairs"], found["links"]],
                    ["rid", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "pairs", "links"],
                )

    schema = f"rid long, key {key_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pairs array<long>, links array<long>"
    path = scratch_path(docs.sparkSession, "aligned")
    found = docs.mapInArrow(run, schema)
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n``: in how many documents each id pair is linked. Tasks count what they read, Spark adds the counts up."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        names, held = ["pair", "n"], None
        for batch in batches:
            seen = batch.column("pairs").flatten()
            for begin in range(0, len(seen), PAIRS_AT_ONCE):
                part = pa.table({"pair": seen.slice(begin, PAIRS_AT_ONCE)}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(names)
                if held is not None:
                    part = pa.concat_tables([held, part]).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(names)
                held = part
                if len(held) > PAIRS_AT_ONCE:
                    yield from held.to_batches()
                    held = None
        if held is not None:
            yield from held.to_batches()

    # the key of a pair is unique per document, so rows are documents
    return aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most_pairs: int) -> tuple[int, DataFrame]:
    """A bound and the pairs counted more often than it, at most ``most_pairs``; the bound is 1 if they allow, else a power of two."""
    # counts 2 | 3, 4 | 5 to 8 | ...: at most 64 rows
    levels = dict(map(tuple, counts.where("n > 1").groupBy(F.ceil(F.log2("n")).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()))
    bound, held = 1 << max(levels, default=0), 0
    for level in sorted(levels, reverse=True):
        held += levels[level]
        if held > most_pairs:
            break
        bound = 1 << (level - 1)
    return bound, counts.where(F.col("n") > bound)


def align_texts(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", key: str = "doc_id", keep_groups: bool = False, most_pairs: int = MOST_PAIRS
) -> DataFrame:
    """One row per document: key, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256`` and ``groups``.

    Tokenizer A is a byte-level BPE file and is given a space before the text, B a sentencepiece model that puts one there. ``groups`` (null unless asked
    for) writes the ids of each group as ``a1,a2|b1;a3|b2,b3``; ``groups_sha256`` is its digest. ``n_links`` is the number of pairs
    of an A and a B token of one group. The count of an id pair is the number of documents that hold it linked; ``n_best`` are the links whose
    count is the highest of their A id, ties included, and ``count_sum`` adds the counts over the links.

    Null and empty texts, and texts whose tokens do not give back the bytes of a space and the text, have no tokens: zeros, '' as
    groups and as digest. Each row is a document of its own, also with equal or null keys; other columns are not looked at. An empty table gives an
    empty result. Nothing is shuffled but counts of pairs. Of them the more frequent ones go to all tasks, at most ``most_pairs``; if there are
    others, the pairs that a document has among those are joined, of which each is in few documents.
    """
    spark = docs.sparkSession
    b_width = Side(PieceTokenizer(b_path)).width
    aligned = _aligned(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), a_path, b_path, keep_groups)
    counts = materialize(pair_counts(aligned), "pair-counts")
    # one row per id of the vocabulary at most
    tops = counts.groupBy(F.expr(f"pair div {b_width}").alias("a")).agg(F.max("n").alias("top"))
    bound, frequent = _frequent(counts, most_pairs)
    held = frequent.orderBy("pair").toPandas()
    highest = tops.toPandas()
    top_of = np.zeros(int(highest["a"].max()) + 1 if len(highest) else 0, np.int64)
    top_of[highest["a"].to_numpy(np.int64)] = highest["top"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((held["pair"].to_numpy(np.int64), held["n"].to_numpy(np.int64), top_of))

    def run(batches) -> Iterator:
        import pyarrow as pa

        pairs_known, n_known, top = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            pair, links = lists.flatten().to_numpy(), batch.column("links").flatten().to_numpy()
            borders = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            if len(pairs_known):
                at = np.minimum(np.searchsorted(pairs_known, pair), len(pairs_known) - 1)
                known = pairs_known[at] == pair
                n = np.where(known, n_known[at], 1)
            else:
                known, n = np.zeros(len(pair), bool), np.ones(len(pair), np.int64)
            # a pair that is not among those counted twice or more is in this document alone
            use = known | (bound == 1)
            best = np.r_[0, np.cumsum(np.where(use & (n == top[pair // b_width]), links, 0))]
            total = np.r_[0, np.cumsum(np.where(use, links * n, 0))]
            left = np.r_[0, np.cumsum(~use)]
            rest = pa.array(left[borders].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, KEPT), pa.array(best[borders[1:]] - best[borders[:-1]]), pa.array(total[borders[1:]] - total[borders[:-1]]),
                 pa.ListArray.from_arrays(rest, pa.array(pair[~use])), pa.ListArray.from_arrays(rest, pa.array(links[~use]))],
                [*KEPT, "n_best", "count_sum", "rest", "rest_links"],
            )

    scored = aligned.mapInArrow(run, ", ".join(f"{c} {aligned.schema[c].dataType.simpleString()}" for c in KEPT) + ", " + SCORED)
    if bound > 1:
        scored = materialize(scored, "scored")
        rest = scored.select("rid", F.explode(F.arrays_zip("rest", "rest_links")).alias("p")).select("rid", F.col("p.rest").alias("pair"), F.col("p.rest_links").alias("links"))
        met = rest.join(counts.where(F.col("n") <= bound), "pair").join(F.broadcast(tops), F.expr(f"pair div {b_width} = a"))
        sums = met.groupBy("rid").agg(F.sum(F.when(F.col("n") == F.col("top"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum"))
        scored = scored.join(sums, "rid", "left")
        for name, more in (("n_best", "more_best"), ("count_sum", "more_sum")):
            scored = scored.withColumn(name, F.col(name) + F.coalesce(more, F.lit(0)))
    return scored.select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")
