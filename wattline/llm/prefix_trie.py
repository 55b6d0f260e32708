"""Conversations as a prefix trie, with subtree totals by centroid decomposition.

A node is a distinct sequence of first turns. Its identity is a 128-bit polynomial hash over the digests of its turns, which can be taken
over parts of a conversation and put together: so a conversation may span many partitions, and its head may be swapped for another's.

Subtree totals come from a centroid decomposition of the parent-edge forest. Each round splits every component that is still large at its
centroid, the deepest node with more than half of the component's mass below it. The component's totals below the centroid are aggregated
and added to the nodes on the path from the centroid to the component's top; then the centroid goes, the parts below its children and the part
above it are components of their own, and the number of rounds is the logarithm of the first mass. Components that are small are decomposed
further in one task each, in the same way. Every pair of a node and one of its ancestors is parted by exactly one centroid, on the path
between them, so each total counts each node once.

Paths need no pointer jumping: the rows of any conversation that passes through a node are the node's ancestors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.batches import bound_batches
from wattline.llm.mixing import word_count
from wattline.storage import BROADCAST_ROWS, materialize

#: Mass up to which a component is decomposed in one task; its number of nodes is at most that.
TASK_MASS = 50_000
#: A key with more rows than this is joined by broadcast of its one partner row; there are few such keys.
HOT_ROWS = 500_000
#: Conversation ids that are written together before their digest is taken.
IDS_AT_ONCE = 50_000

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MODULUS = 1 << 64
ROOT = bytes(16)


class Heads(NamedTuple):
    """Every conversation gets the first ``count`` turns (at most ``most``) of conversation ``base`` in place of its own."""

    base: Column
    count: Column
    most: int


def meet(rows: DataFrame, one: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Inner join with ``one`` (a row per key). The few keys in ``hot`` have many rows; these stay where they are and get their partner by broadcast."""
    if hot is None:
        return rows.join(one, key)
    hot = F.broadcast(hot.select(key))
    still = rows.join(F.broadcast(one.join(hot, key, "left_semi")), key)
    return still.unionByName(rows.join(hot, key, "left_anti").join(one, key))


def hot_keys(counts: DataFrame, key: str, n: str) -> DataFrame | None:
    """Keys with more than ``HOT_ROWS`` rows, or None; at most one in ``HOT_ROWS`` of the rows has such a key."""
    found = counts.where(F.col(n) > HOT_ROWS).select(key)
    return found if found.limit(1).count() else None


def few(keys: DataFrame) -> DataFrame:
    """A written table of one narrow row per key, broadcast if its count allows."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _power(base: int, exponent: int) -> np.uint64:
    return np.uint64(pow(base, exponent, MODULUS))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1)."""
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps)


def _scan(conv: np.ndarray, digests: np.ndarray, carry: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Place of each turn in its conversation and the hash before and after it. ``digests`` has two columns.

    ``carry`` holds the conversation, place and hashes at the end of the batch before, and is brought forward.
    """
    n = len(conv)
    first = np.r_[True, conv[1:] != conv[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    same = carry[0] is not None and carry[0] == conv[0]
    head = start == 0
    place = np.arange(n) - start + 1 + np.where(head & same, carry[1], 0)
    found = []
    for k, base in enumerate(BASES):
        inverse = pow(base, -1, MODULUS)
        terms = digests[:, k] * _powers(base, n)
        total = np.cumsum(terms)
        # base ** (place of the segment's first turn - its index)
        shift = _powers(inverse, n)[start] * np.uint64(base)
        begin = total[start] - terms[start]
        known = np.zeros(n, np.uint64)
        if same:
            shift[head] = _power(base, carry[1] + 1)
            known[head] = carry[2 + k]
        found += [known + (total - terms - begin) * shift, known + (total - begin) * shift]
    carry[:] = [conv[-1], int(place[-1]), found[1][-1], found[3][-1]]
    return place, [found[0], found[2], found[1], found[3]]


PLACED = "part int, conv long, place long, words int, before_a long, before_b long, after_a long, after_b long"
SUMS = ("before_a", "before_b", "after_a", "after_b")


def _place_turns(narrow: DataFrame) -> DataFrame:
    """Turns in order over range partitions, with place and hashes counted from the first turn that the partition has of a conversation."""

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, carry = TaskContext.get().partitionId(), [None, 0, 0, 0]
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "<u8").reshape(-1, 2).astype(np.uint64)
            place, sums = _scan(conv, digests, carry)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(conv), part, np.int32)), batch.column("conv"), pa.array(place), batch.column("words"), *(pa.array(s.view(np.int64)) for s in sums)],
                [c.split()[0] for c in PLACED.split(", ")],
            )

    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "digest", "words")
    return materialize(dealt.mapInArrow(run, PLACED), "turns")


def _join_parts(placed: DataFrame) -> DataFrame:
    """Places and hashes counted from the first turn of the whole conversation. At most one conversation per border between partitions is concerned."""
    borders = sorted(map(tuple, placed.groupBy("part").agg(F.min("conv"), F.max("conv")).collect()))
    spans = sorted({a[2] for a, b in zip(borders, borders[1:], strict=False) if a[2] == b[1]})
    if not spans:
        return placed
    spark = placed.sparkSession
    last = F.max(F.struct("place", "after_a", "after_b")).alias("last")
    listed = F.broadcast(spark.createDataFrame([(c,) for c in spans], "conv long"))
    told = placed.join(listed, "conv", "left_semi").groupBy("conv", "part").agg(last).collect()
    state, known = {}, {}
    for conv, part, (place, *sums) in sorted((r[0], r[1], tuple(r[2])) for r in told):
        before = known[conv, part] = state.get(conv, (0, 0, 0))
        state[conv] = (before[0] + place, *((b + pow(base, before[0], MODULUS) * s) % MODULUS for b, base, s in zip(before[1:], BASES, sums, strict=True)))
    shared = spark.sparkContext.broadcast({key: value for key, value in known.items() if value[0]})

    def run(batches) -> Iterator:
        import pyarrow as pa

        parts: dict[int, list] = {}
        for (conv, part), value in shared.value.items():
            parts.setdefault(part, []).append((conv, value))
        for batch in batches:
            part, conv = batch.column("part").to_numpy(), batch.column("conv").to_numpy()
            columns = {c: batch.column(c).to_numpy().copy() for c in ("place", *SUMS)}
            for number in np.unique(part).tolist():
                for of, (offset, *sums) in parts.get(number, ()):
                    rows = (part == number) & (conv == of)
                    columns["place"][rows] += offset
                    for c in SUMS:
                        k = 0 if c.endswith("a") else 1
                        columns[c][rows] = (np.uint64(sums[k]) + columns[c][rows].view(np.uint64) * _power(BASES[k], offset)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(columns[c]) if c in columns else batch.column(c) for c in batch.schema.names], batch.schema.names)

    return placed.mapInArrow(run, PLACED)


PATHS = "conv long, depth long, node binary, parent binary, words int, turns long"


def _swap_heads(turns: DataFrame, plans: DataFrame, hot: DataFrame | None) -> DataFrame:
    """The paths of all conversations, a row per node on them. ``plans`` has ``taken`` turns of the base in place of the first ``dropped`` own ones."""
    own = meet(turns.drop("part"), plans.drop("heads"), "conv", hot).where("place > dropped")

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            get = {c: batch.column(c).to_numpy() for c in batch.schema.names}
            move = get["taken"] - get["dropped"]
            ends = {}
            for side in ("before", "after"):
                pair = []
                for k, base in zip("ab", BASES, strict=True):
                    steps, index = np.unique(move, return_inverse=True)
                    power = np.array([_power(base, int(s)) for s in steps], np.uint64)[index]
                    since = get[f"{side}_{k}"].view(np.uint64) - get[f"own_{k}"].view(np.uint64)
                    pair.append(get[f"base_{k}"].view(np.uint64) + since * power)
                ends[side] = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(move), [None, pa.py_buffer(np.stack(pair, 1).tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), pa.array(get["place"] + move), ends["after"], ends["before"], batch.column("words"), batch.column("turns")],
                [c.split()[0] for c in PATHS.split(", ")],
            )

    # a head that is taken is a path with nothing before it
    head = plans.where("taken > 0").select("conv", "turns", F.explode(F.slice("heads", F.lit(1), F.col("taken").cast("int"))).alias("h"))
    zero = {c: F.lit(0).cast("long").alias(c) for c in ("own_a", "own_b", "base_a", "base_b", "taken", "dropped")}
    taken = head.select("conv", "turns", F.col("h.place").alias("place"), F.col("h.words").alias("words"), *[F.col(f"h.{c}").alias(c) for c in SUMS], *zero.values())
    paths = own.unionByName(taken).mapInArrow(run, PATHS)
    roots = plans.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("words"), "turns")
    return materialize(paths.unionByName(roots), "paths")


def trie_paths(conversations: DataFrame, conv: str, turn: str, role: str, text: str, heads: Heads | None) -> tuple[DataFrame, DataFrame | None]:
    """One row per conversation and depth: ``conv``, ``depth``, ``node``, ``parent``, ``words`` (of the last turn), ``turns`` (of the conversation).
    And the conversations with very many turns."""
    said = [F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))]
    digest = F.unhex(F.md5(F.concat(F.length(said[0]).cast("string"), F.lit(":"), *said).cast("binary")))
    narrow = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"), word_count(text).cast("int").alias("words")
    )
    turns = _join_parts(_place_turns(narrow))
    most = heads.most if heads else 0
    start = F.when(F.col("place") <= most, F.struct("place", "words", *SUMS))
    convs = turns.groupBy("conv").agg(F.max("place").alias("n"), F.sort_array(F.collect_list(start)).alias("starts"))
    convs = materialize(convs, "conversations")
    if heads:
        wanted = convs.withColumn("base", heads.base).withColumn("dropped", F.least(heads.count, F.lit(most)).cast("long"))
        bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"), F.col("starts").alias("heads"))
        plans = wanted.join(bases, "base", "left").withColumn("taken", F.least("dropped", F.coalesce("base_n", F.lit(0))))
    else:
        plans = convs.withColumn("dropped", F.lit(0).cast("long")).withColumn("taken", F.col("dropped")).withColumn("heads", F.col("starts"))

    def hash_at(list_of: str, place: str, name: str) -> Column:
        return F.when((F.col(place) > 0) & (F.size(list_of) >= F.col(place)), F.get(list_of, F.col(place).cast("int") - 1).getField(name)).otherwise(F.lit(0).cast("long"))

    plans = plans.select(
        "conv", "heads", "taken", "dropped", (F.col("taken") + F.greatest(F.col("n") - F.col("dropped"), F.lit(0))).alias("turns"),
        *[hash_at("starts", "dropped", f"after_{k}").alias(f"own_{k}") for k in "ab"], *[hash_at("heads", "taken", f"after_{k}").alias(f"base_{k}") for k in "ab"],
    )
    hot = hot_keys(convs, "conv", "n")
    return _swap_heads(turns, plans, hot), hot


def _ends(paths: DataFrame) -> DataFrame:
    """``node``, ``ends_sha256`` over the ids of the conversations that end there. Ids are written together where they are sorted, so one node's
    ids reach the task that takes its digest as few rows, and stream through it."""

    def write(batches) -> Iterator:
        import pyarrow as pa

        node, ids = None, []
        found: list[tuple] = []

        def pack():
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.string()), strict=True)], ["node", "least", "ids"])

        for batch in batches:
            for at, conv in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist(), strict=True):
                if ids and (at != node or len(ids) >= IDS_AT_ONCE):
                    found.append((node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = at
                ids.append(conv)
            yield pack()
        if ids:
            found.append((node, ids[0], ",".join(map(str, ids))))
            yield pack()

    def digest(batches) -> Iterator:
        import hashlib

        import pyarrow as pa

        node, state = None, None
        for batch in batches:
            nodes, sums = [], []
            for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if at == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    nodes.append(node)
                    sums.append(state.hexdigest())
                node, state = at, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sums, pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    ends = paths.where("depth = turns").select("node", "conv")
    packed = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(write, "node binary, least long, ids string")
    return packed.repartition("node").sortWithinPartitions("node", "least").mapInArrow(digest, "node binary, ends_sha256 string")


def tree_sums(parent: list[int], weights: list[list[float]]) -> list[list[float]]:
    """Subtree sums of one tree by centroid decomposition. Parents come before their children; the first has parent -1."""
    sums = [[0] * len(parent) for _ in weights]
    size, label = [0] * len(parent), [0] * len(parent)
    parts = [list(range(len(parent)))] if parent else []
    while parts:
        nodes = parts.pop()
        top, n = nodes[0], len(nodes)
        for u in nodes:
            size[u] = 1
        for u in reversed(nodes[1:]):
            size[parent[u]] += size[u]
        centroid = next(u for u in reversed(nodes) if 2 * size[u] > n)
        below: dict[int, list[int]] = {}
        above, totals = [], [w[centroid] for w in weights]
        for u in nodes:
            if u == centroid:
                label[u] = -2
                continue
            up = label[parent[u]] if u != top else -1
            # -1 above the centroid, -2 for itself, else the child of the centroid that it is under
            label[u] = u if up == -2 else up
            if label[u] == -1:
                above.append(u)
            else:
                below.setdefault(label[u], []).append(u)
                for k, w in enumerate(weights):
                    totals[k] += w[u]
        u = centroid
        while True:
            for k, total in enumerate(totals):
                sums[k][u] += total
            if u == top:
                break
            u = parent[u]
        parts += below.values()
        if above:
            parts.append(above)
    return sums


STATE = "comp binary, node binary, parent binary, depth long, conv long, mass long, leaves long, saved long, n_leaves long, saved_tokens long"


def _finish(nodes: DataFrame) -> DataFrame:
    """The totals of components of bounded size, each decomposed in one task."""
    columns = ["node", "parent", "leaves", "saved", "n_leaves", "saved_tokens"]

    def sums_of(rows: list[list]) -> Iterator[tuple]:
        place = {row[0]: k for k, row in enumerate(rows)}
        found = tree_sums([-1, *(place[row[1]] for row in rows[1:])], [[row[2] for row in rows], [row[3] for row in rows]])
        for row, leaves, saved in zip(rows, *found, strict=True):
            yield row[0], row[4] + leaves, row[5] + saved

    def run(batches) -> Iterator:
        import pyarrow as pa

        comp, rows, done = None, [], []

        def pack():
            columns = list(zip(*done, strict=True)) or [(), (), ()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64()), strict=True)], ["node", "n_leaves", "saved_tokens"])

        for batch in batches:
            for at, *row in zip(batch.column("comp").to_pylist(), *(batch.column(c).to_pylist() for c in columns), strict=True):
                if at != comp and rows:
                    done.extend(sums_of(rows))
                    rows = []
                comp = at
                rows.append(row)
            yield pack()
        if rows:
            done.extend(sums_of(rows))
            yield pack()

    dealt = nodes.repartition("comp").sortWithinPartitions("comp", "depth").select("comp", *columns)
    return dealt.mapInArrow(run, "node binary, n_leaves long, saved_tokens long")


def _split(state: DataFrame, paths: DataFrame, large: DataFrame, hot: DataFrame | None) -> DataFrame:
    """One round: all components of ``large`` (comp, total, top) lose their centroid. ``removed`` marks it, ``comp`` is the new component of the others."""
    within = state.join(few(large), "comp")
    heavy = F.struct("depth", "node", "conv", "mass")
    centroids = materialize(within.where("2 * mass > total").groupBy("comp", "top").agg(F.max(heavy).alias("c")), "centroids")
    centroids = few(centroids.select("comp", "top", F.col("c.node").alias("centroid"), F.col("c.depth").alias("level"), F.col("c.conv").alias("of"), F.col("c.mass").alias("cut")))
    # conversations that go on below a centroid, with the child they go to
    through = paths.join(centroids, F.col("parent") == F.col("centroid")).select("conv", F.struct("comp", F.col("node").alias("child"), "level").alias("way"))
    ways = through.groupBy("conv").agg(F.collect_list("way").alias("ways"))
    known = within.select("conv").distinct().join(ways, "conv", "left")
    met = meet(within.drop("total", "top"), known, "conv", hot)
    # a conversation passes few centroids of one round: components part it
    way = F.get(F.filter("ways", lambda w: (w["comp"] == F.col("comp")) & (F.col("depth") > w["level"])), F.lit(0))
    marked = met.withColumn("child", way.getField("child")).drop("ways").join(centroids.select("comp", "centroid"), "comp")
    marked = materialize(marked, "marked")
    under = marked.where(F.col("child").isNotNull() | (F.col("node") == F.col("centroid")))
    totals = under.groupBy("comp").agg(F.sum("leaves").alias("add_leaves"), F.sum("saved").alias("add_saved"))
    cuts = few(materialize(centroids.join(totals, "comp"), "cuts"))
    # from the centroid to the top: rows of a conversation through the centroid
    upward = paths.join(cuts, (F.col("conv") == F.col("of")) & (F.col("depth") <= F.col("level")) & (F.col("depth") >= F.col("top")))
    upward = upward.select("node", "add_leaves", "add_saved", "cut")
    found = marked.join(upward, "node", "left")
    zero = F.lit(0).cast("long")
    removed = F.col("node") == F.col("centroid")
    return materialize(
        found.select(
            F.coalesce("child", "comp").alias("comp"), "node", "parent", "depth", "conv", (F.col("mass") - F.coalesce("cut", zero)).alias("mass"), "leaves", "saved",
            (F.col("n_leaves") + F.coalesce("add_leaves", zero)).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("add_saved", zero)).alias("saved_tokens"), removed.alias("removed"),
        ),
        "split",
    )


def subtree_totals(nodes: DataFrame, paths: DataFrame, task_mass: int = TASK_MASS, hot: DataFrame | None = None) -> DataFrame:
    """``node, n_leaves, saved_tokens``: sums of ``leaves`` and ``saved`` over each node's subtree.

    ``nodes``: node, parent, depth, conv, leaves, saved. ``paths``: conv, depth, node, parent, turns of one conversation per
    node that any ends at; so every node has rows. The mass of a node is their number in its subtree.
    """
    mass = paths.groupBy("node").agg(F.sum(F.col("turns") - F.col("depth") + 1).alias("mass"))
    state = nodes.join(mass, "node").withColumn("comp", F.lit(ROOT)).withColumn("n_leaves", F.lit(0).cast("long")).withColumn("saved_tokens", F.lit(0).cast("long"))
    names = [c.split()[0] for c in STATE.split(", ")]
    state = materialize(state.select(*names), "state")
    done = None

    def add(part: DataFrame) -> None:
        nonlocal done
        done = part if done is None else done.unionByName(part)

    while True:
        sizes = state.groupBy("comp").agg(F.max("mass").alias("total"), F.min("depth").alias("top"))
        # masses of components add up to at most the whole, so one in task_mass rows is large
        large = materialize(sizes.where(F.col("total") > task_mass), "large")
        if not large.count():
            break
        add(_finish(state.join(few(large), "comp", "left_anti")))
        split = _split(state, paths, large, hot)
        add(split.where("removed").select("node", "n_leaves", "saved_tokens"))
        state = split.where("not removed").select(*names)
    add(_finish(state))
    return done


def prefix_trie(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", heads: Heads | None = None, task_mass: int = TASK_MASS
) -> DataFrame:
    """One row per distinct sequence of first turns (role, text), the empty one included: ``conv_id`` (smallest conversation that starts with it), ``depth``,
    ``parent_conv_id``, ``n_convs`` (conversations that start with it), ``n_children``, ``n_leaves`` (childless nodes in its subtree), ``saved_tokens``
    (over its subtree, words of each node's last text times one less than its conversations), ``ends_sha256`` (of the ids of those that end with it,
    ascending, comma-joined), and ``node`` (its hash).

    Turns are ordered by ``turn``, nulls first, then by the MD5 of ``length of role:role text``; repeated rows are turns of their own. Null roles and texts are
    empty. Rows without a conversation belong to none and are left out. ``heads`` swaps first turns; a base that does not exist has none,
    a conversation may so lose all its turns and ends at the root. Other columns are not looked at. An empty table gives an empty result.
    """
    bound_batches(conversations.sparkSession)
    paths, hot = trie_paths(conversations, conv, turn, role, text, heads)
    least_end = F.min(F.when(F.col("depth") == F.col("turns"), F.col("conv")))
    nodes = paths.groupBy("node", "parent", "depth", "words").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), least_end.alias("owner"))
    nodes = materialize(nodes, "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = materialize(nodes, "nodes")
    leaves = (F.col("n_children") == 0).cast("long").alias("leaves")
    weighed = nodes.select("node", "parent", "depth", "conv", leaves, ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    # of the conversations with the same turns one is enough to have the paths of all nodes
    owners = nodes.where("owner is not null").select(F.col("owner").alias("conv"))
    owned = materialize(meet(paths, owners, "conv", hot).select("conv", "depth", "node", "parent", "turns"), "owned")
    totals = subtree_totals(weighed, owned, task_mass, hot)
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    told = meet(nodes.where("parent is not null").select("node", "parent"), parents, "parent", hot_keys(children.withColumnRenamed("node", "parent"), "parent", "n_children"))
    out = nodes.drop("parent").join(totals, "node").join(told.select("node", "parent_conv"), "node", "left").join(_ends(paths), "node", "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"), "node",
    )
