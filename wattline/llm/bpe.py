"""Byte-level BPE by a pair occurrence index.

A task gathers the distinct pieces of its texts that it has not met before, lays their symbols out in one array, and keeps an
index from the rank of each adjacent pair to its positions. Ranks that are active are taken in ascending order; a rank's
merge is applied at all its positions at once, and only the lists of the neighbouring pairs change. This gives each piece
the same ids as merging its lowest rank first, since pieces share no pair.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import give_back, pieces

#: Splits a text into pieces before merging; a fixed value of the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Known pieces of a task; the memory of the table is bounded by both.
CACHE_PIECES = 100_000
CACHE_CHARS = 6 << 20
#: Bytes of text whose new pieces are merged together; the more, the fewer times each rank is taken.
TEXT_BYTES = 1 << 20


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, to the byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids, merge ranks and added tokens of a byte-level BPE file."""

    def __init__(self, text: str):
        file = json.loads(text)
        model = file["model"]
        to_byte = byte_symbols()
        self.bytes_of: dict[int, bytes] = {
            i: bytes(to_byte[c] for c in s) if all(c in to_byte for c in s) else s.encode() for s, i in model["vocab"].items()
        }
        ids = model["vocab"]
        self.byte_id = [0] * 256
        for shown, byte in to_byte.items():
            self.byte_id[byte] = ids[shown]
        ranked = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            ranked.append((ids[left], ids[right], rank, ids[left + right]))
        table = np.array(ranked, np.int64).reshape(-1, 4)
        #: Left, right and merged symbol of each rank, and the pairs in order with their ranks.
        self.left, self.right, self.merged = table[:, 0], table[:, 1], table[:, 3]
        self.width = int(max(ids.values())) + 2
        keys = self.left * self.width + self.right
        order = np.argsort(keys, kind="stable")
        self.pairs, self.rank_of = keys[order], order
        self.added = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or -1."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.rank_of[at], -1)


def merge_pieces(texts: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Ids of each piece, by one pair occurrence index over all of them.

    The symbols of all pieces lie end to end with a border (-1) before, between and behind. ``after`` and ``before`` link
    the symbols that are left; a merged symbol stays at the place of its left part.
    """
    if not len(vocabulary.pairs):
        return [[vocabulary.byte_id[b] for b in t] for t in texts]
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    size = int(lengths.sum()) + len(texts) + 1
    symbols = np.full(size, -1, np.int32)
    inner = np.ones(size, bool)
    inner[0] = False
    inner[starts + lengths] = False
    symbols[inner] = np.array(vocabulary.byte_id, np.int32)[np.frombuffer(b"".join(texts), np.uint8)]
    after, before = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
    where: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def index(places: np.ndarray, ranks: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        borders = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        for rank, begin, end in zip(ranks[borders].tolist(), borders.tolist(), [*borders[1:].tolist(), len(ranks)], strict=True):
            lists = where.get(rank)
            if lists is None:
                where[rank] = [places[begin:end]]
                heapq.heappush(active, rank)
            else:
                lists.append(places[begin:end])

    ranks = vocabulary.ranks(symbols[:-1], symbols[1:])
    some = np.flatnonzero(ranks >= 0)
    if len(some):
        index(some, ranks[some])
    while active:
        rank = heapq.heappop(active)
        lists = where.pop(rank)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        left, right = int(vocabulary.left[rank]), int(vocabulary.right[rank])
        # a place may be stale: merged away, or changed by a merge beside it
        at = at[symbols[at] == left]
        at = at[symbols[after[at]] == right]
        if left == right and len(at) > 1:
            # in a row of equal symbols every second pair overlaps the one before
            fresh = np.r_[True, at[1:] != after[at[:-1]]]
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        follow = after[gone]
        symbols[at] = vocabulary.merged[rank]
        symbols[gone] = -2
        after[at] = follow
        before[follow] = at
        places = np.concatenate([before[at], at])
        ranks = vocabulary.ranks(symbols[places], symbols[after[places]])
        some = ranks >= 0
        if some.any():
            index(places[some], ranks[some])
    left_over = symbols >= 0
    counts = np.add.reduceat(left_over, starts) * (lengths > 0) if len(texts) else np.empty(0, np.int64)
    flat = symbols[left_over].tolist()
    ends = np.cumsum(counts).tolist()
    return [flat[e - c : e] for c, e in zip(counts.tolist(), ends, strict=True)]


class Encoder:
    """Encodes and decodes whole texts; keeps what it knows of pieces it has met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.vocabulary = vocabulary
        self.find = regex.compile(PATTERN).findall
        self.added = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.added, key=len, reverse=True))) + ")") if vocabulary.added else None
        self.digits = {i: str(i) for i in vocabulary.bytes_of}
        self._forget()

    def _forget(self) -> None:
        # an added token is known by a tuple, which no piece of a text equals
        self.written: dict = {(t,): str(i) for t, i in self.vocabulary.added.items()}
        #: Decoded bytes of the pieces, where they are not the piece itself.
        self.bytes: dict = {}
        self.chars = 0

    def split(self, texts: list[str]) -> list[list]:
        """Pieces and added tokens of each text; after this all of them are known. New pieces are merged together."""
        out = []
        for text in texts:
            if self.added is None or not any(t in text for t in self.vocabulary.added):
                out.append(self.find(text))
                continue
            parts: list = []
            for k, part in enumerate(self.added.split(text)):
                parts.extend([(part,)] if k % 2 else self.find(part))
            out.append(parts)
        if len(self.written) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self._forget()
        new = list(set().union(*out).difference(self.written))
        self.chars += sum(map(len, new))
        for piece, ids in zip(new, merge_pieces([p.encode() for p in new], self.vocabulary), strict=True):
            self.written[piece] = ",".join(map(self.digits.__getitem__, ids))
            raw = self.decode_bytes(ids)
            if raw != piece.encode():
                self.bytes[piece] = raw
        return out

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text."""
        for written, _ in self.written_and_decoded(texts):
            yield [int(i) for i in written.split(",")] if written else []

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def written_and_decoded(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Ids joined by commas, and the text decoded from them. Pieces are written and decoded once while they are known."""
        for parts in self.split(texts):
            written = ",".join(map(self.written.__getitem__, parts))
            if self.bytes:
                raw = b"".join([self.bytes[p] if p in self.bytes else (p[0] if type(p) is tuple else p).encode() for p in parts])
                yield written, raw.decode("utf-8", "replace")
            else:
                yield written, "".join([p[0] if type(p) is tuple else p for p in parts] if self.added is not None else parts)


def read_vocabulary(spark, path: str) -> str:
    """The vocabulary file as text, read once by the driver; about 2 MB, a size that does not depend on the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_texts(docs: DataFrame, vocabulary_path: str, text: str = "text", key: str = "doc_id", ids: bool = True, decoded: bool = True) -> DataFrame:
    """Encode and decode every whole text: key, ``n_tokens``, ``ids`` (null unless asked for), ``ids_sha256``, ``decoded``
    (null unless asked for), ``decoded_sha256``.

    Null texts count as empty: no tokens, the digest of the empty string. Rows keep their number and null keys stay; equal
    texts have equal ids; an empty table gives an empty result. Added tokens of the vocabulary are matched in the text,
    as its library does. There is no shuffle. The vocabulary is broadcast.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary_path))
    kind = docs.schema[key].dataType

    def run(batches):
        import pyarrow as pa

        encoder = Encoder(Vocabulary(shared.value))
        for batch in batches:
            for piece in pieces(batch, "text", TEXT_BYTES):
                texts = [t or "" for t in piece.column("text").to_pylist()]
                counts, id_lists, id_sums, backs, decoded_sums = [], [], [], [], []
                for written, back in encoder.written_and_decoded(texts):
                    counts.append(written.count(",") + 1 if written else 0)
                    id_sums.append(hashlib.sha256(written.encode()).hexdigest())
                    decoded_sums.append(hashlib.sha256(back.encode()).hexdigest())
                    id_lists.append(np.array(written.split(","), np.int32) if ids and written else [] if ids else None)
                    backs.append(back if decoded else None)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(counts, pa.int64()), pa.array(id_lists, pa.list_(pa.int32())), pa.array(id_sums, pa.string()),
                     pa.array(backs, pa.string()), pa.array(decoded_sums, pa.string())],
                    ["key", "n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"],
                )
        # the worker lives on
        del encoder
        give_back()

    schema = f"key {kind.simpleString()}, n_tokens long, ids array<int>, ids_sha256 string, decoded string, decoded_sha256 string"
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, schema).withColumnRenamed("key", key)
