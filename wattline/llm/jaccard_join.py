"""N-gram Jaccard join as a blocked sparse product of documents by n-grams.

The product of the incidence matrix with its transpose counts how many n-grams two documents share. It is never built
whole: for similarity t two sets of sizes a <= b can only link if a >= t * b, and if they share one of the first
``size - ceil(t * size) + 1`` n-grams of each in any fixed global order.

The order is by the number of documents that have an n-gram, rare ones first. Those that one document has alone are no entries of
the product; they only fill the front of its order. So a document whose first n-grams are its own meets no other one, and a passage
that many documents share brings no two of them together unless they have little else. Only what is left becomes rows, blocked by n-gram.

Documents with equal sets are one class and are compared once. In a block pairs are not expanded: each round compares every
member with few hubs, those of its blocks' hubs that it shares most entries with, links are merged to components, and only pairs of different
components remain. When these are few, or hubs find few links, the shared entries of all pairs that remain are counted, pairs that cannot
reach the overlap which their sizes ask for are dropped, and the others are compared; so the components are exactly those of the
full join. Overlaps are counted on the n-grams that more than one document has.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.batches import give_back, pieces, text_bytes
from wattline.llm.components import components
from wattline.llm.words import gram_hashes, mix, span_hashes, word_spans
from wattline.storage import materialize

WORDS = 5
#: Similarity as a fraction of integers, so that borders are exact.
PERCENT = 75
#: An n-gram seen this often, counting only repeats inside a task's pieces, is common: it comes last in the order and is not counted again.
COMMON = 1000
#: Most common n-grams that are sent to all tasks (8 bytes each), the most frequent first. Others are counted like all.
MOST_COMMON = 1_000_000
#: Entries of the incidence matrix that a block has on average, and that a task gathers before it deals them to blocks; and of these at least, per block.
BLOCK_ENTRIES, ENTRIES_AT_ONCE, ENTRIES_PER_ROW = 1 << 19, 1 << 18, 64
#: Bytes of text that are shingled together; a longer text is taken alone.
SHINGLE_BYTES = 512 << 10
#: Rounds with hubs go on while at least one in so many of the pairs they compare is a link.
PAIRS_PER_LINK = 20
#: Pairs of different components are expanded once they are no more than so many times the entries.
PAIRS_PER_ENTRY = 8
#: Entries of a document that go with each of them when pairs are made.
MOST_CARRIED = 256
#: Hubs that a member is compared with in one round.
HUBS = 3
#: Members of one hub that one task streams over.
SLOT_ROWS = 2000
#: Narrow tables (keys only) of at most so many rows are broadcast, after they are counted; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def shingle_sets(texts, words: int = WORDS):
    """The sorted hashes of the distinct shingles of each text of an Arrow array; fewer words make one shingle."""
    raw, borders = text_bytes(texts)
    starts, ends, first = word_spans(raw, borders)
    hashed = span_hashes(raw, starts, ends, fold=True)
    grams = gram_hashes(hashed, words)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        elif b > a:
            yield mix(gram_hashes(hashed[a:b], int(b - a)) + np.uint64(b - a))
        else:
            yield np.empty(0, np.uint64)


def _profiles(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: ``rid``, ``id``, ``text_hash``, ``n``, ``sig``; and n-grams that repeat inside a piece of texts, in its first row: ``again``, ``times``."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in pieces(batch, "text", SHINGLE_BYTES):
                sizes, sigs, sets = [], [], []
                for grams in shingle_sets(piece.column("text"), words):
                    sizes.append(len(grams))
                    sigs.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
                    sets.append(grams)
                grams, counts = np.unique(np.concatenate(sets), return_counts=True)
                many = counts > 1
                blank = [None] * (len(sizes) - 1)
                rids = np.arange(rid, rid + len(sizes), dtype=np.int64)
                rid += len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rids), piece.column("id"), piece.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()),
                     pa.array([grams[many].view(np.int64), *blank], pa.list_(pa.int64())), pa.array([counts[many], *blank], pa.list_(pa.int64()))],
                    ["rid", "id", "text_hash", "n", "sig", "again", "times"],
                )

    return docs.mapInArrow(run, f"rid long, id {kind}, text_hash long, n long, sig binary, again array<long>, times array<long>")


def _common_grams(profiles: DataFrame, least: int, most: int) -> np.ndarray:
    """Hashes of frequent n-grams, ascending: repeats inside pieces of text are summed over the corpus."""
    repeats = profiles.where("again is not null").select(F.explode(F.arrays_zip("again", "times")).alias("r"))
    sums = repeats.groupBy(F.col("r.again").alias("gram")).agg(F.sum("r.times").alias("n")).where(F.col("n") >= least)
    found = sums.orderBy(F.desc("n"), "gram").limit(most).select("gram").toPandas()["gram"].to_numpy(np.int64)
    return np.sort(found.view(np.uint64))


def _pack(places: np.ndarray, buckets: int, *columns: np.ndarray):
    """Entries as one row per bucket: (bucket, the bytes of its part of each column), entries in the order they have."""
    order = np.argsort(places, kind="stable")
    borders = np.searchsorted(places[order], np.arange(buckets + 1))
    parts = [c[order] for c in columns]
    for k in np.flatnonzero(np.diff(borders)).tolist():
        yield k, *(p[borders[k] : borders[k + 1]].tobytes() for p in parts)


def _deltas(nodes: bytes) -> bytes:
    """Ascending 64-bit numbers as differences, which compress well."""
    return np.diff(np.frombuffer(nodes, np.int64), prepend=0).tobytes()


def _batch(rows: list[tuple], schema):
    """Rows as one batch; it holds what was gathered, a bounded number of entries."""
    import pyarrow as pa

    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema.names)


def _bucketed(batches, columns: int):
    """For each bucket of rows sorted by bucket: its number and the rows' other columns, one list each."""
    bucket, rows = None, []
    for batch in batches:
        for at, *row in zip(*(batch.column(k).to_pylist() for k in range(columns + 1)), strict=True):
            if at != bucket and rows:
                yield bucket, list(zip(*rows, strict=True))
                rows = []
            bucket = at
            rows.append(row)
    if rows:
        yield bucket, list(zip(*rows, strict=True))


def _short(grams: bytes) -> bytes:
    """The lower six bytes of 64-bit hashes. With the block that they are in, they name an n-gram by more than 48 bits."""
    return np.frombuffer(grams, np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(short: bytes, block: int) -> np.ndarray:
    out = np.zeros((len(short) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(short, np.uint8).reshape(-1, 6)
    return out.view(np.uint64)[:, 0] | np.uint64((block & 0xFFFF) << 48)


def _place(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit hash, by its upper half."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


#: Last classes of the order: as many documents or more, and common n-grams, which are not counted.
VERY_FREQUENT, KNOWN_COMMON = 254, 255


def _df_class(df: np.ndarray) -> np.ndarray:
    """Numbers of documents as one byte that keeps their order: exact up to 127, by eighths of a power of two beyond."""
    power = np.floor(np.log2(np.maximum(df, 1)) * 8).astype(np.int64)
    return np.where(df < 128, df, np.minimum(128 + power - 56, VERY_FREQUENT)).astype(np.uint8)


#: A block: of entries in order of their documents, the documents, n-grams and classes of counts. ``of`` is the block by n-gram that they were in.
_BLOCKS = "bucket int, of int, nodes binary, grams binary, classes binary"


def _block_schema():
    import pyarrow as pa

    return pa.schema([("bucket", pa.int32()), ("of", pa.int32()), ("nodes", pa.binary()), ("grams", pa.binary()), ("classes", pa.binary())])


def _incidence(texts: DataFrame, words: int, common: np.ndarray, buckets: int) -> DataFrame:
    """The incidence matrix in blocks. ``texts``: (node, text).

    The first ``buckets`` are blocks by n-gram, with no class yet. Those behind are blocks by document: its size, as an n-gram of class 0, and what it has of
    common n-grams, which need no counting.
    """
    shared = texts.sparkSession.sparkContext.broadcast(common)
    at_once = max(ENTRIES_AT_ONCE, buckets * ENTRIES_PER_ROW)

    def run(batches):
        known, schema = shared.value, _block_schema()
        held, size = [], 0

        def pack():
            held.sort(key=lambda h: h[0])
            often = [_among(known, g) for _, g in held]
            nodes = np.repeat([n for n, _ in held], [len(g) - int(o.sum()) for (_, g), o in zip(held, often, strict=True)])
            grams = np.concatenate([g[~o] for (_, g), o in zip(held, often, strict=True)])
            rows = [(k, k, _deltas(n), _short(g), None) for k, n, g in _pack(_place(grams, buckets), buckets, nodes, grams)]
            nodes = np.repeat([n for n, _ in held], [int(o.sum()) + 1 for o in often])
            grams = np.concatenate([np.r_[np.uint64(len(g)), g[o]] for (_, g), o in zip(held, often, strict=True)])
            classes = np.concatenate([np.r_[np.uint8(0), np.full(int(o.sum()), KNOWN_COMMON, np.uint8)] for o in often])
            places = _place(mix(nodes.view(np.uint64)), buckets)
            rows += [(buckets + k, 0, _deltas(n), _short(g), c) for k, n, g, c in _pack(places, buckets, nodes, grams, classes)]
            held.clear()
            return _batch(rows, schema)

        for batch in batches:
            for piece in pieces(batch, "text", SHINGLE_BYTES):
                for node, grams in zip(piece.column("node").to_pylist(), shingle_sets(piece.column("text"), words), strict=True):
                    if len(grams):
                        held.append((node, grams))
                        size += len(grams)
                if size >= at_once:
                    yield pack()
                    size = 0
                    give_back()
        if held:
            yield pack()

    return texts.mapInArrow(run, _BLOCKS)


def _among(known: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Which of ``grams`` are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(grams), bool)
    return known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams


def _counted(incidence: DataFrame, buckets: int) -> DataFrame:
    """Entries whose n-gram more than one document has, with the class of its count, and all that need no counting; in blocks by document.

    An n-gram's entries meet in one block of bounded size.
    """

    def run(batches):
        schema = _block_schema()
        for bucket, (of, nodes, grams, classes) in _bucketed(batches, 4):
            if bucket >= buckets:
                yield _batch([(bucket - buckets, *row) for row in zip(of, nodes, grams, classes, strict=True)], schema)
                continue
            nodes = np.concatenate([np.cumsum(np.frombuffer(n, np.int64)) for n in nodes])
            grams = _long(b"".join(grams), 0)
            order = np.argsort(grams, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(grams[order]) != 0])
            df = np.diff(np.r_[first, len(grams)])
            # in place of the entries that are alone in their n-gram nothing is kept
            kept = order[np.repeat(df > 1, df)]
            classes = np.repeat(_df_class(df[df > 1]), df[df > 1])
            order = np.argsort(nodes[kept], kind="stable")
            kept, classes = kept[order], classes[order]
            nodes, grams = nodes[kept], grams[kept]
            places = _place(mix(nodes.view(np.uint64)), buckets)
            yield _batch([(k, bucket, _deltas(n), _short(g), c) for k, n, g, c in _pack(places, buckets, nodes, grams, classes)], schema)
            give_back()

    dealt = incidence.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, _BLOCKS)


def _shared_sets(counted: DataFrame, percent: int) -> DataFrame:
    """Documents that can link at all: ``node``, ``n``, ``grams`` (those that others have too, ascending, 8 bytes each) and ``prefix``, its entries of the product.

    All other n-grams of a document are its own and come first in the order, so the prefix is what its length leaves for the shared ones.
    """
    import pyarrow as pa

    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("grams", pa.binary()), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        for _, (of, nodes, grams, classes) in _bucketed(batches, 4):
            nodes = np.concatenate([np.cumsum(np.frombuffer(n, np.int64)) for n in nodes])
            grams = np.concatenate([_long(g, k) for k, g in zip(of, grams, strict=True)])
            classes = np.frombuffer(b"".join(classes), np.uint8)
            order = np.lexsort((grams, classes, nodes))
            nodes, grams = nodes[order], grams[order]
            first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
            # the size comes first
            n = grams[first].astype(np.int64)
            left = np.diff(np.r_[first, len(nodes)]) - 1 + (-percent * n // 100) + 1
            rows, held = [], 0
            for k in np.flatnonzero(left > 0).tolist():
                a = int(first[k]) + 1
                b = int(first[k + 1]) if k + 1 < len(first) else len(nodes)
                rows.append((int(nodes[a]), int(n[k]), np.sort(grams[a:b]).tobytes(), grams[a : a + left[k]].view(np.int64)))
                held += b - a
                if held >= ENTRIES_AT_ONCE:
                    yield _batch(rows, schema)
                    rows, held = [], 0
            yield _batch(rows, schema)
            give_back()

    dealt = counted.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "node long, n long, grams binary, prefix array<long>")


def _small(keys: DataFrame) -> DataFrame:
    """A written table of keys, broadcast if its count allows."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``pairs`` that link: 100 * overlap >= percent * union.

    The sets of all a go to their b in bounded slots, each slot gets the set of b once and first, and a task holds one set of b
    while the others stream past.
    """
    counts = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("rows"))
    sized = counts.select("b", F.ceil(F.col("rows") / SLOT_ROWS).cast("int").alias("slots"))
    heads = sized.select("b", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    heads = heads.select("b", "slot", F.lit(None).cast("long").alias("a"), F.col("b").alias("of"))
    rest = pairs.join(sized, "b").withColumn("slot", F.pmod(F.xxhash64("a"), F.col("slots")).cast("int"))
    places = materialize(heads.union(rest.select("b", "slot", "a", F.col("a").alias("of"))), "places")
    met = sets.join(_small(places), F.col("of") == F.col("node")).select("b", "slot", "a", "n", "grams")
    dealt = met.repartition("b", "slot").sortWithinPartitions("b", "slot", F.col("a").asc_nulls_first())

    def run(batches):
        import pyarrow as pa

        hub, size = np.empty(0, np.uint64), 0
        for batch in batches:
            left, right = [], []
            for a, b, n, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "n", "grams")), strict=True):
                grams = np.frombuffer(raw, np.uint64)
                if a is None:
                    hub, size = grams, n
                    continue
                short, long = (grams, hub) if len(grams) < len(hub) else (hub, grams)
                at = np.minimum(np.searchsorted(long, short), len(long) - 1)
                both = int((long[at] == short).sum())
                if 100 * both >= percent * (n + size - both):
                    left.append(a)
                    right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def _fits(a: str, b: str, percent: int):
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def _short_prefix():
    """A document's entries in their order, or null if they are many: then its pairs are made by every entry, and counted."""
    return F.when(F.size("prefix") <= MOST_CARRIED, F.col("prefix"))


def _reaches(shared: Column, a: str, b: str, percent: int):
    """Whether sets of sizes a and b that share ``shared`` entries of the product (a column) can link.

    Of the set whose entries end first in the order, all n-grams up to there are entries, and of the other one too. So the overlap is
    the shared entries and at most what that set has behind its entries: ``ceil(t * size) - 1``.
    """
    behind = F.greatest(*[F.floor((percent * F.col(c) + 99) / 100) - 1 for c in (a, b)])
    return (100 + percent) * (shared + behind) >= percent * (F.col(a) + F.col(b))


def _blocks(entries: DataFrame, turn: int) -> DataFrame:
    """Blocks with more than one component: ``gram``, ``pairs`` of different components, and a ``hub``, another one each turn."""
    hub = F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), F.col("node").alias("b"), F.col("n").alias("m"), F.col("comp").alias("comp_b"))
    if turn:
        parts = entries.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("k"), F.min(hub).alias("hub"))
    else:
        # every class is still its own component
        parts = entries.select("gram", F.lit(1).cast("long").alias("k"), hub.alias("hub"))
    k, kk = F.sum("k"), F.sum(F.col("k") * F.col("k"))
    blocks = parts.groupBy("gram").agg(((k * k - kk) / 2).alias("pairs"), F.min("hub").alias("hub"))
    return blocks.where("pairs > 0").select("gram", "pairs", "hub.b", "hub.m", "hub.comp_b")


def link_classes(entries: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``node, comp`` of all classes that link with another one. ``entries``: (gram, node, n); ``sets``: (node, n, grams, prefix)."""
    spark = entries.sparkSession
    labels = spark.createDataFrame([], "node long, comp long")
    edges = tested = None
    now, rows, links = entries.withColumn("comp", F.col("node")), entries.count(), 0
    compared = 0
    for turn in range(rows):
        if turn and links:
            now = now.drop("comp").join(labels, "node", "left").select("gram", "node", "n", F.coalesce("comp", "node").alias("comp"))
        blocks = materialize(_blocks(now, turn), "blocks")
        left = blocks.agg(F.sum("pairs").alias("pairs")).first()["pairs"]
        if not left:
            break
        # blocks of one component are done for good
        met = now.join(blocks, "gram")
        now = materialize(met.drop("pairs"), "entries")
        last = turn > 0 and (links * PAIRS_PER_LINK <= compared or left <= PAIRS_PER_ENTRY * now.count())
        pairs = now
        if last:
            # a pair is made once, by the first entry that both have, and only if all entries that both have reach far enough
            own = now.select("gram", "node", "n", "comp").join(sets.select("node", _short_prefix().alias("own")), "node")
            # both sides are the same rows under the same names, so that Spark deals them out once
            left, right = own.alias("left"), own.alias("right")
            both = F.array_intersect("left.own", "right.own")
            made_here = both.isNull() | ((F.get(both, F.lit(0)) == F.col("left.gram")) & _reaches(F.size(both), "left.n", "right.n", percent))
            apart = (F.col("left.node") < F.col("right.node")) & (F.col("left.comp") != F.col("right.comp")) & _fits("left.n", "right.n", percent)
            pairs = left.join(right, (F.col("left.gram") == F.col("right.gram")) & apart & made_here)
            pairs = pairs.select(F.col("left.node").alias("node"), F.col("right.node").alias("b"), F.col("left.n").alias("n"), F.col("right.n").alias("m"), both.alias("both"))
            both = F.col("both")
            pairs = pairs.withColumn("entries", F.when(both.isNull(), 1).otherwise(F.size(both)))
        else:
            pairs = pairs.where((F.col("comp") != F.col("comp_b")) & _fits("n", "m", percent)).withColumn("entries", F.lit(1))
        fresh = pairs.groupBy(F.col("node").alias("a"), "b").agg(F.sum("entries").alias("shared"), F.first("n").alias("n"), F.first("m").alias("m"))
        if last:
            fresh = fresh.where(_reaches(F.col("shared"), "n", "m", percent))
        if tested is not None:
            fresh = fresh.join(tested, ["a", "b"], "left_anti")
        if not last:
            # few hubs for each member: those that it shares most entries with
            hubs = F.sort_array(F.collect_list(F.struct("shared", "b")), asc=False)
            fresh = fresh.groupBy("a").agg(F.slice(hubs, 1, HUBS).alias("hubs")).select("a", F.explode("hubs.b").alias("b"))
        fresh = materialize(fresh.select("a", "b"), "pairs")
        found = materialize(_verify(fresh, sets, percent), "links")
        links, compared = found.count(), fresh.count()
        if links:
            edges = found if edges is None else edges.union(found)
            labels = materialize(components(edges), "labels")
        if last:
            break
        both = fresh.union(fresh.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tested = both if tested is None else tested.union(both)
        now = now.select("gram", "node", "n", "comp")
    return labels


def _texts_of(source: DataFrame, profiles: DataFrame, heads: DataFrame) -> DataFrame:
    """``node, text`` of the rows ``heads``, met by key and text."""
    # rows that repeat id and text would bring the text of their class several times
    repeated = profiles.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    repeated = repeated.select(F.col("id").alias("again_id"), F.col("text_hash").alias("again_hash"))
    wanted = heads.join(repeated, (F.col("text_hash") == F.col("again_hash")) & F.col("id").eqNullSafe(F.col("again_id")), "left").select(
        F.col("rid").alias("node"), F.col("id").alias("of_id"), F.col("text_hash").alias("of_hash"), F.col("again_hash").isNotNull().alias("repeats")
    )
    wanted = _small(materialize(wanted, "wanted"))
    met = source.join(wanted, (F.col("text_hash") == F.col("of_hash")) & F.col("id").eqNullSafe(F.col("of_id"))).select("node", "text", "repeats")
    return met.where("not repeats").drop("repeats").union(met.where("repeats").drop("repeats").dropDuplicates(["node"]))


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``text_hash``, ``n_shingles``, ``component_id``, and ``component``, a number per component.

    A document's set are its distinct shingles of lower-cased words (see `shingle_sets`). Documents link when
    ``100 * overlap >= percent * union``; ``component_id`` is the smallest key that can be reached by links. Null and empty texts, and
    texts without words, have no shingle, link with nothing and are their own component. Repeated rows link with each other.
    Null keys are reached by no key: a component of null keys only has a null id. An empty table gives an empty result.
    """
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    profiles = materialize(_profiles(source, words), "profiles")
    common = _common_grams(profiles, COMMON, MOST_COMMON)
    whole = isinstance(docs.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    named_alike = profiles.where("n > 0").groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1 or id is null")
    # keys that name one row each number the rows; else they are numbered as they were read
    by_key = whole and named_alike.isEmpty()
    if by_key:
        profiles = profiles.withColumn("rid", F.col("id").cast("long"))
    filled = profiles.where("n > 0")
    classes = materialize(
        filled.groupBy("sig").agg(F.min("rid").alias("node"), F.min("id").alias("least_id"), F.count(F.lit(1)).alias("rows")), "classes"
    )
    again = materialize(filled.join(classes.where("rows > 1").select("sig", "node"), "sig").where("rid <> node").select("rid"), "copies")
    heads = filled.join(_small(again), "rid", "left_anti").select("rid", "id", "text_hash", "n")
    if by_key:
        texts = source.select(F.col("id").cast("long").alias("node"), "text")
        texts = texts.join(_small(again.withColumnRenamed("rid", "node")), "node", "left_anti")
    else:
        texts = _texts_of(source, profiles, heads)
    buckets = int(heads.agg(F.sum("n")).first()[0] or 0) // BLOCK_ENTRIES + 1
    counted = _counted(_incidence(texts, words, common, buckets), buckets)
    sets = materialize(_shared_sets(counted, percent), "sets")
    entries = materialize(sets.select(F.explode("prefix").alias("gram"), "node", "n"), "entries")
    labels = link_classes(entries, sets, percent)
    placed = classes.join(labels, "node", "left").select("sig", F.coalesce("comp", "node").alias("comp"), "least_id")
    least = placed.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    named = placed.join(least, "comp").select("sig", "comp", "component_id")
    out = profiles.join(named, "sig", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce("comp", "rid").alias("component"),
    )


def near_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest key, and every text without words."""
    found = jaccard_components(docs, text, key, words, percent)
    single = found.where("n_shingles = 0").select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), F.lit(False).alias("once"))
    first = (
        found.where("n_shingles > 0").groupBy("component")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
        .select(F.col("first.doc_id").alias("of_id"), F.col("first.text_hash").alias("of_hash"), F.lit(True).alias("once"))
    )
    stay = single.distinct().union(first)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.col(text)).alias("hash"))
    met = rows.join(stay, (F.col("hash") == F.col("of_hash")) & F.col("row").getField(key).eqNullSafe(F.col("of_id")))
    place = F.row_number().over(Window.partitionBy("hash", "of_id").orderBy(F.xxhash64("row")))
    return met.withColumn("place", place).where(~F.col("once") | (F.col("place") == 1)).select("row.*")
