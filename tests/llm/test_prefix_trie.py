"""The prefix trie against a plain restatement, with the bounds lowered so that rounds, borders and hot keys are met."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def heads():
    conv = F.col("conv")
    return trie.Heads(conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, 3)


def by_hand(rows, swap):
    said = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            said.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in said.items()}
    built = own
    if swap:
        counts = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
        built = {c: own.get(c - int(np.fmod(c, 20)), [])[: counts[c]] + turns[counts[c] :] for c, turns in own.items()}
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved, out = {}, {}, {}, []
    for path in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = leaves.get(path, 0) or 1
        saved[path] = saved.get(path, 0) + (len(nodes[path]) - 1) * words
        if path:
            up = path[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[path]
            saved[up] = saved.get(up, 0) + saved[path]
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), children.get(path, 0), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, swap=True, parts=5, **options):
    data = spark.createDataFrame(rows, SCHEMA).repartition(parts).select("*", *[F.lit("x").alias(c) for c in ("conv", "node", "parent", "depth", "place", "part", "words", "comp")])
    found = trie.prefix_trie(data, heads=heads() if swap else None, **options).select(*COLUMNS)
    return sorted(map(tuple, found.collect()), key=repr)


def mixed_rows(seed=3):
    draw = random.Random(seed)
    rows = []
    for c in [*range(0, 61), 80, 100, 105, -3, -40, -41]:
        for t in range(draw.choice([1, 2, 3, 3, 4, 7])):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a b c", "hello", "hello", "x", ""])))
    # copies of one conversation, one long conversation and its near copy, nulls, ties, repeated rows, no conversation
    rows += [(c, t, "user", f"same {t}") for c in range(200, 230) for t in range(4)]
    rows += [(c, t, "user", f"long {t % 7}") for c in (300, 301) for t in range(150 + c - 300)]
    rows += [(400, None, "user", "first"), (400, 0, None, None), (400, 0, None, None), (400, 0, "user", "b"), (400, 0, "user", "a"), (None, 1, "user", "lost")]
    rows += [(c, 0, "user", "w " * 3000) for c in (500, 501)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("swap", [True, False])
def test_equals_the_restatement(spark, swap):
    rows = mixed_rows()
    assert run(spark, rows, swap) == by_hand(rows, swap)


def test_rounds_borders_and_hot_keys(spark, monkeypatch):
    rows = mixed_rows(8)
    monkeypatch.setattr(trie, "HOT_ROWS", 20)
    monkeypatch.setattr(trie, "IDS_AT_ONCE", 4)
    monkeypatch.setattr(trie, "BROADCAST_ROWS", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rounds, split = [], trie._split
    monkeypatch.setattr(trie, "_split", lambda *given: rounds.append(1) or split(*given))
    try:
        assert run(spark, rows, task_mass=60) == by_hand(rows, True)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # 300 rows of one path and its copy, halved until 60 are left, and the root
    assert 3 <= len(rounds) <= 8


def test_one_turnless_and_no_conversation(spark):
    rows = [(5, 0, "user", "gone")]
    count = zlib.crc32(b"5") % 4
    assert count > 0 and run(spark, rows) == by_hand(rows, True) == [(5, 0, None, 1, 0, 1, 0, hashlib.sha256(b"5").hexdigest())]
    assert run(spark, []) == [] and run(spark, [(None, 1, "user", "x")]) == []


def test_tree_sums():
    draw = random.Random(1)
    for n in (1, 2, 3, 10, 200):
        for shape in (1, 3, n):
            parent = [-1, *(draw.randint(max(0, k - shape), k - 1) for k in range(1, n))]
            weights = [[draw.randint(0, 9) for _ in range(n)] for _ in range(2)]
            expected = [list(w) for w in weights]
            for u in range(n - 1, 0, -1):
                for e in expected:
                    e[parent[u]] += e[u]
            assert trie.tree_sums(parent, weights) == expected
    chain = trie.tree_sums([-1, *range(20_000)], [[1] * 20_001])
    assert chain[0][0] == 20_001 and chain[0][-1] == 1


def test_scan_over_batches():
    draw = np.random.default_rng(2)
    conv = np.repeat([1, 2, 3, 9], [5, 1, 30, 4])
    digests = draw.integers(0, 1 << 64, (40, 2), np.uint64)
    place, whole = trie._scan(conv, digests, [None, 0, 0, 0])
    assert place.tolist() == [*range(1, 6), 1, *range(1, 31), *range(1, 5)]
    for k, base in enumerate(trie.BASES):
        expected = [sum(int(d) * pow(base, j + 1, 1 << 64) for j, d in enumerate(digests[i - place[i] + 1 : i + 1, k])) % (1 << 64) for i in range(40)]
        assert whole[2 + k].tolist() == expected
    carry, parts = [None, 0, 0, 0], []
    for at in range(0, 40, 3):
        parts.append(trie._scan(conv[at : at + 3], digests[at : at + 3], carry))
    assert np.concatenate([p[0] for p in parts]).tolist() == place.tolist()
    assert all(np.concatenate([p[1][k] for p in parts]).tolist() == whole[k].tolist() for k in range(4))
