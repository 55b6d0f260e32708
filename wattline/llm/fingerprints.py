"""Document fingerprints from improbable features.

Each window of 64 bytes gets a rarity from its entropy; windows that are the rarest of many neighbourhoods are selected;
a selected window's hash sets five bits of a Bloom filter of 2048 bits, and a full filter is followed by the next. Two
fingerprints are compared by the overlap of their filters' bits, normalised by what chance alone would give.

Rarity is fixed: it does not depend on the corpus, so fingerprints of different corpora can be compared.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.words import mix
from wattline.storage import materialize

WINDOW = 64
FILTER_BITS = 2048
HASHES = 5
#: Distinct features of one filter.
FILTER_FEATURES = 160
#: Of the 64 neighbourhoods that a window is part of, those in which it must be the rarest.
LEAST_WINS = 16
#: Windows of less entropy (bits a byte) are too regular to tell documents apart.
LEAST_ENTROPY = 1.5
#: Entropy of usual prose, in bits a byte; windows far from it are rare.
USUAL_ENTROPY = 4.05
#: Bytes of text in one numpy step; small steps stay in a core's cache.
STEP_BYTES = 1 << 17
#: Bytes from a window's start on which its selection can depend, to either side.
REACH = 2 * WINDOW

_LOG = np.r_[0.0, np.log2(np.arange(1, WINDOW + 2))]
_WEIGHT = np.arange(WINDOW + 2) * _LOG
#: Changes of the sum in units of 2^-30, so that sums do not depend on what lies around a window.
_ENTER = np.round(np.diff(_WEIGHT) * (1 << 30)).astype(np.int64)
_RANDOM = np.random.default_rng(77).integers(0, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_entropies(raw: np.ndarray) -> np.ndarray:
    """Entropy of the bytes of every window, in bits.

    A byte that enters a window changes the sum of c * log2(c) by an amount that depends on how often it occurs among the
    63 bytes before; one that leaves, on the 63 bytes after. Both counts come from the places of each byte value in order.
    """
    n = len(raw)
    order = np.argsort(raw, kind="stable")
    key = raw[order].astype(np.int64) * (n + WINDOW) + order
    here = np.arange(n)
    # equal bytes among the WINDOW - 1 before; the ones after are the same pairs seen from the other end
    from_ = np.searchsorted(key, key - (WINDOW - 1))
    until = np.cumsum(np.bincount(from_, minlength=n))
    before, after = np.empty(n, np.int64), np.empty(n, np.int64)
    before[order] = here - from_
    after[order] = until - here - 1
    total = np.cumsum(_ENTER[before])
    total[WINDOW:] -= np.cumsum(_ENTER[after[: n - WINDOW]])
    return np.log2(WINDOW) - total[WINDOW - 1 :] / (WINDOW * (1 << 30))


def window_rarities(raw: np.ndarray) -> np.ndarray:
    """Rarity of every window: whole steps of distance from the usual entropy, ties broken by its own bytes; 0 for regular windows."""
    entropy = window_entropies(raw)
    steps = 1 + np.round(np.abs(entropy - USUAL_ENTROPY) * 256).astype(np.int64)
    return np.where(entropy < LEAST_ENTROPY, 0, (steps << 16) + raw[: len(entropy)].astype(np.int64) * 256 + raw[WINDOW - 1 :])


def selected_windows(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every selected window, and its text: the rarest, leftmost of equals, of enough neighbourhoods.

    Texts start at ``borders`` and end a gap of ``WINDOW`` bytes before the next.
    """
    if len(raw) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rarity = window_rarities(raw)
    # only windows inside a text count
    size = np.diff(borders) - WINDOW
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[borders[:-1]] = 1
    inside[(borders[:-1] + size - WINDOW + 1)[size >= WINDOW]] = -1
    inside[borders[:-1][size < WINDOW]] = 0
    rarity[np.cumsum(inside[: len(rarity)]) == 0] = 0
    shift = len(rarity)
    best = rarity * shift + (shift - 1 - np.arange(shift))
    span = 1
    while span < WINDOW and len(best) > span:
        best = np.maximum(best[: len(best) - span], best[span:])
        span *= 2
    wins = np.bincount(shift - 1 - best % shift, minlength=shift)
    at = np.flatnonzero((wins >= LEAST_WINS) & (rarity > 0))
    return at, np.searchsorted(borders, at, side="right") - 1


def _hashes(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    grams = raw[at[:, None] + np.arange(WINDOW)].astype(np.uint64) if len(at) else np.empty((0, WINDOW), np.uint64)
    return mix(((grams + np.uint64(1)) * _RANDOM).sum(axis=1, dtype=np.uint64))


def selected_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place in its text, text and hash of each selected window."""
    borders = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    # every text lies between gaps that no neighbourhood spans, so it is seen alike wherever it lies
    apart = borders + WINDOW * np.arange(1, len(borders) + 1)
    spread = np.zeros(len(raw) + WINDOW * (len(texts) + 1), np.uint8)
    spread[np.arange(len(raw)) + WINDOW * np.repeat(np.arange(1, len(texts) + 1), np.diff(borders))] = raw
    at, owner = selected_windows(spread, apart)
    return at - apart[owner], owner, _hashes(spread, at)


def _rarest(text: bytes) -> list[int]:
    """Features of a text without a selected window: its rarest windows, or the text as a whole."""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) >= WINDOW:
        rarity = window_rarities(raw)
        if rarity.max() > 0:
            return _hashes(raw, np.flatnonzero(rarity == rarity.max())).tolist()
    return [int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")] if text else []


def _complete(texts: list[bytes], owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text in order of the text; texts without any get their rarest."""
    lone = np.setdiff1d(np.arange(len(texts)), owner)
    more = [(k, v) for k in lone.tolist() for v in _rarest(texts[k])]
    owner = np.r_[owner, np.array([k for k, _ in more], np.int64)]
    value = np.r_[value, np.array([v for _, v in more], np.uint64)]
    order = np.argsort(owner, kind="stable")
    value, owner = value[order], owner[order]
    pairs = np.lexsort((np.arange(len(value)), value, owner))
    again = np.zeros(len(value), bool)
    same = (value[pairs][1:] == value[pairs][:-1]) & (owner[pairs][1:] == owner[pairs][:-1])
    again[pairs[1:][same]] = True
    return value[~again], owner[~again]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct features of each text, in order of the text: (hash, text)."""
    _, owner, value = selected_features(texts)
    return _complete(texts, owner, value)


def _filters(count: int, value: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Chained filters of ``count`` texts."""
    counts = np.bincount(owner, minlength=count)
    first = np.cumsum(counts) - counts
    chain = -(-counts // FILTER_FEATURES)
    base = np.cumsum(chain) - chain
    row = base[owner] + (np.arange(len(value)) - first[owner]) // FILTER_FEATURES if len(value) else np.empty(0, np.int64)
    bits = np.zeros((int(chain.sum()), FILTER_BITS), bool)
    for k in range(HASHES):
        bits[row, (value >> np.uint64(11 * k)).astype(np.int64) & (FILTER_BITS - 1)] = True
    packed = np.packbits(bits, axis=1)
    return [packed[b : b + c] for b, c in zip(base, chain, strict=True)]


def digests(texts: list[bytes]) -> list[np.ndarray]:
    """The chained filters of each text, as packed rows; an empty text has none."""
    return _filters(len(texts), *features(texts))


def digests_with_edits(texts: list[bytes], changed: list[bytes], same: list[int]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Filters of texts and of their edited forms, which agree in the first ``same`` bytes.

    Windows that end well before the edit are selected in both alike, so only the rest of an edited text is looked at.
    """
    place, owner, value = selected_features(texts)
    own = _filters(len(texts), *_complete(texts, owner, value))
    border = np.maximum(np.array(same, np.int64) - REACH, 0)
    start = np.maximum(border - REACH, 0)
    late, late_owner, late_value = selected_features([c[s:] for c, s in zip(changed, start.tolist(), strict=True)])
    early = place < border[owner]
    behind = late + start[late_owner] >= border[late_owner]
    owner, value = np.r_[owner[early], late_owner[behind]], np.r_[value[early], late_value[behind]]
    return own, _filters(len(texts), *_complete(changed, owner, value))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1. Each filter of the shorter chain meets its best partner; shared bits count beyond what chance gives."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    x, y = a.view(np.uint64), b.view(np.uint64)
    mine, theirs = np.bitwise_count(x).sum(axis=1, dtype=np.int64), np.bitwise_count(y).sum(axis=1, dtype=np.int64)
    total = 0.0
    for k in range(len(x)):
        both = np.bitwise_count(x[k] & y).sum(axis=1, dtype=np.int64)
        chance = mine[k] * theirs / FILTER_BITS
        most = np.minimum(mine[k], theirs)
        total += float(np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0.0, 1.0).max()) * mine[k]
    return total / float(mine.sum())


def fingerprint_text(rows: np.ndarray) -> str:
    return base64.b64encode(rows.tobytes()).decode("ascii")


def fingerprint_rows(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, FILTER_BITS // 8)


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by as many, or all, from the start of the next."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _compare(texts: list[str], following: list[str]) -> dict[str, list]:
    """All output columns for texts and the texts that follow them."""
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    same = [len(t[: len(t) - len(t) // 4].encode()) for t in texts]
    raw = [t.encode() for t in changed]
    own, other = digests_with_edits([t.encode() for t in texts], raw, same)
    # most texts that follow are the next of the list itself
    place = {id(t): k for k, t in enumerate(texts)}
    late = [k for k, f in enumerate(following) if id(f) not in place]
    ahead = dict(zip(late, digests([following[k].encode() for k in late]), strict=True))
    nexts = [ahead[k] if k in ahead else own[place[id(f)]] for k, f in enumerate(following)]
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(t).hexdigest() for t in raw],
        "fingerprint": [fingerprint_text(x) for x in own],
        "edited_fingerprint": [fingerprint_text(x) for x in other],
        "near_edited": [likeness(a, b) for a, b in zip(own, other, strict=True)],
        "near_next": [likeness(a, b) for a, b in zip(own, nexts, strict=True)],
    }


_COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _arrays(keys, found: dict[str, list]):
    import pyarrow as pa

    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return [keys, *[pa.array(v, k) for v, k in zip(found.values(), kinds, strict=True)]]


def _in_order(docs: DataFrame) -> DataFrame:
    """Results of all rows but the last of each partition, and the first and last row of each partition as text.

    Rows are range-partitioned and sorted by key, so a row's follower is the next row of its partition.
    """
    kind = docs.schema["key"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "role", "text"]
        held: list = []
        held_bytes, first = 0, True

        def results(keep: int):
            done = held[:-1] if keep else held
            if not done:
                return None
            texts = [t for _, t in held]
            found = _compare(texts[: len(done)], texts[1 : len(done) + 1])
            keys = pa.array([k.as_py() for k, _ in done], pa_kind)
            n = len(done)
            return pa.RecordBatch.from_arrays([*_arrays(keys, found), pa.array([part] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.nulls(n, pa.string())], names)

        def border(row, role):
            key, text = row
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([key.as_py()], pa_kind), *empty, pa.array([part], pa.int32()), pa.array([role], pa.int32()), pa.array([text], pa.string())], names)

        for batch in batches:
            pa_kind = batch.column("key").type
            for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
                row = (key, text.as_py() or "")
                if first:
                    yield border(row, 1)
                    first = False
                held.append(row)
                held_bytes += len(row[1])
                if held_bytes >= STEP_BYTES and len(held) > 1:
                    out = results(1)
                    if out is not None:
                        yield out
                    held, held_bytes = held[-1:], len(held[-1][1])
        if held:
            out = results(1)
            if out is not None:
                yield out
            yield border(held[-1], 2)

    return docs.mapInArrow(run, f"key {kind}, {_COLUMNS}, part int, role int, text string")


def fingerprint_texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: key, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (base64 of the filters),
    ``near_edited``, ``near_next``.

    The next document is the one with the next key; the last one's is the first; a lone document follows itself. Rows with equal keys
    are ordered by a hash of their text, null keys come last. Null texts count as empty; an empty text has an empty
    fingerprint, which is like another empty one (1) and unlike all others (0). An empty table gives an empty result.

    One shuffle, by range. Only the first and last row of each partition cross partitions: they are joined afterwards.
    """
    narrow = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("key").isNull(), F.col("key").asc_nulls_last(), F.xxhash64("text")]
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialize(_in_order(dealt), "fingerprints")
    inner = found.where("role = 0").drop("part", "role", "text")
    # one row per partition: these windows never see documents
    heads = found.where("role = 1").select("part", F.col("text").alias("following"))
    last = F.max("part").over(Window.partitionBy(F.lit(0)))
    parts = heads.select("part", F.coalesce(F.lag("part").over(Window.orderBy("part")), last).alias("of_part"))
    after = parts.join(heads, "part").select("of_part", "following")
    tails = found.where("role = 2").select("part", "key", "text")
    met = tails.join(after, F.col("part") == F.col("of_part")).select("key", "text", "following")
    kind = narrow.schema["key"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                found = _compare(row.column("text").to_pylist(), row.column("following").to_pylist())
                yield pa.RecordBatch.from_arrays(_arrays(row.column("key"), found), ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    border = met.mapInArrow(run, f"key {kind}, {_COLUMNS}")
    return inner.union(border).withColumnRenamed("key", key)
