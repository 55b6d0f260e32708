"""Exact, near and substring deduplication against brute force, with edge rows, hot groups and empty tables."""

import hashlib
from collections import Counter, defaultdict

import pytest

from wattline.llm import exact_dedup, fm_index, jaccard_join, substring_dedup
from wattline.llm import components as component_module
from wattline.llm.components import components

from .conftest import SCHEMA, edge_rows, prose


def exact_expected(rows, keep):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    pick = max if keep == "largest" else min
    out = []
    for doc_id, text, *_ in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep_id = pick(ids) if ids else None
        out.append((doc_id, keep_id, len(groups[text or ""]), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_edges(edge_docs, keep):
    found = exact_dedup.exact_dedup(edge_docs, keep=keep).collect()
    assert sorted(((r["row"]["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found), key=repr) == exact_expected(edge_rows(), keep)
    kept = Counter(r["text_sha256"] for r in found if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t, *_ in edge_rows()})
    # the row comes back whole, null text and clashing names included
    assert Counter(r["row"]["text"] for r in found) == Counter(t for _, t, *_ in edge_rows())
    assert all(r["row"]["kept"] == "extra kept" and r["row"]["row"] == "extra row" for r in found)


def test_exact_hot_group(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_RUN_ROWS", 3)
    rows = [(i, "copy" if i % 3 else f"own {i}", "en", "s", 1) for i in range(3000)]
    found = exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA), keep="largest", carry=False).select("row.*", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found.collect()), key=repr) == exact_expected(rows, "largest")
    assert found.where("kept").count() == 1001


def test_exact_plan_is_native_and_sorts_in_place(edge_docs):
    plan = exact_dedup.exact_dedup(edge_docs)._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window"):]
    assert "Python" not in plan and "Arrow" not in plan
    assert "rangepartitioning" in window and "hashpartitioning" not in window[: window.index("rangepartitioning")]


def shingles(text):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    words = [w.translate(lower) for w in (text or "").encode().split()]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def near_expected(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(list)
    for k, (doc_id, *_) in enumerate(rows):
        least[find(k)].append(doc_id)
    out = []
    for k, (doc_id, *_) in enumerate(rows):
        ids = [i for i in least[find(k)] if i is not None]
        out.append((doc_id, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=repr), len(least)


@pytest.mark.parametrize("changes", [{}, {"COMMON": 1, "PAIRS_PER_LINK": 10**9, "SLOT_ROWS": 2}, {"MOST_COMMON": 1, "COMMON": 2}])
def test_near_edges(edge_docs, monkeypatch, changes):
    for name, value in changes.items():
        monkeypatch.setattr(jaccard_join, name, value)
    found = jaccard_join.jaccard_components(edge_docs).collect()
    expected, _ = near_expected(edge_rows())
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == expected


@pytest.mark.parametrize("changes", [{}, {"PAIRS_PER_LINK": 0, "COMMON": 2, "SLOT_ROWS": 5}, {"BLOCK_ENTRIES": 90, "ENTRIES_AT_ONCE": 40, "PAIRS_PER_ENTRY": 0, "SHINGLE_BYTES": 900}, {"PAIRS_PER_LINK": 10**9, "MOST_CARRIED": 12}])
def test_near_group_and_common_passage(spark, monkeypatch, changes):
    for name, value in changes.items():
        monkeypatch.setattr(jaccard_join, name, value)
    base, passage = prose(5, 80).split(), prose(6, 60)
    rows = []
    for i in range(60):
        words = [*base]
        words[(i * 7) % 80] = f"edit{i}"
        if i % 4 == 0:
            words[(i * 11 + 3) % 80] = f"more{i}"
        rows.append((i, " ".join(words), "en", "s", 1))
    rows += [(100 + i, passage + " " + prose(50 + i, 60), "en", "s", 1) for i in range(40)]
    # a chain: neighbours link, the ends do not
    rows += [(200 + i, " ".join(prose(7, 140).split()[4 * i : 4 * i + 100]), "en", "s", 1) for i in range(10)]
    expected, groups = near_expected(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    found = jaccard_join.jaccard_components(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == expected
    assert jaccard_join.near_dedup(docs).count() == groups


def test_near_dedup_keeps_one(edge_docs):
    kept = jaccard_join.near_dedup(edge_docs)
    assert kept.columns == edge_docs.columns
    expected, groups = near_expected(edge_rows())
    assert kept.count() == groups


@pytest.mark.parametrize("few", [0, 200_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(component_module, "FEW_EDGES", few)
    edges = [(1, 2), (2, 3), (3, 4), (9, 4), (20, 21), (22, 21), (5, 5)]
    found = {r.node: r.comp for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 9: 1, 20: 20, 21: 20, 22: 20}


def substring_expected(rows, window):
    words = [(t or "").encode().split() for _, t, *_ in rows]
    seen = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (doc_id, *_), w in zip(rows, words, strict=True):
        cut = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                cut[k : k + window] = [True] * window
        kept = b" ".join(x for x, c in zip(w, cut, strict=True) if not c)
        out.append((doc_id, len(w), sum(cut), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_words", [1_000_000, 100])
def test_substring_edges(edge_docs, shard_words):
    rows = edge_rows() if shard_words > 1000 else [(i, t and t[:4000], *r) for i, t, *r in edge_rows()]
    docs = edge_docs if shard_words > 1000 else edge_docs.sparkSession.createDataFrame(rows, SCHEMA)
    found = substring_dedup.substring_dedup(docs, shard_words=shard_words).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=repr) == substring_expected(rows, 35)
    assert all(sum(x.high - x.low for x in r.removed) == r.n_removed for r in found)


@pytest.mark.parametrize("shard_words", [1_000_000, 20])
def test_substring_periods(spark, shard_words):
    # at period 28 the minimizer recurs just beyond a window, so all windows are one run without a tie
    rows = [
        (period * 100 + n, " ".join([f"p{period}n{n}w{k}" for k in range(period)] * n), None, None)
        for period in (27, 28, 29, 56) for n in (2, 3, 5)
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = substring_dedup.substring_dedup(docs, shard_words=shard_words).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=repr) == substring_expected(rows, 35)
    assert {r.doc_id for r in found if r.n_removed} == {r[0] for r in rows if len(r[1].split()) - r[0] // 100 >= 35}


def test_index_counts():
    import numpy as np

    rng = np.random.default_rng(3)
    lengths = rng.integers(4, 40, 30)
    words = rng.integers(1, 4, lengths.sum())
    weights = np.ones(30, np.int64)
    index = fm_index.ShardIndex(words, lengths, weights, 4)
    found = index.repeated(step=5)
    parts = np.split(words, np.cumsum(lengths)[:-1])
    seen = Counter(tuple(p[k : k + 4]) for p in parts for k in range(len(p) - 3))
    for start, p in zip(index.starts, parts, strict=True):
        for k in range(len(p) - 3):
            assert found[start + k] == (seen[tuple(p[k : k + 4])] > 1)


def test_empty_tables(no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    assert jaccard_join.jaccard_components(no_docs).count() == 0
    assert jaccard_join.near_dedup(no_docs).count() == 0
    assert substring_dedup.substring_dedup(no_docs).count() == 0


def test_classes_of_counts_keep_their_order():
    import numpy as np

    df = np.unique(np.r_[np.arange(1, 5000), 2 ** np.arange(12, 40), 3 ** np.arange(9, 24)])
    classes = jaccard_join._df_class(df).astype(int)
    assert (np.diff(classes) >= 0).all() and classes[126] == 127 and classes[127] == 128 and classes[-1] == jaccard_join.VERY_FREQUENT


def test_blocks_keep_their_entries():
    import numpy as np

    rng = np.random.default_rng(4)
    grams, nodes = rng.integers(0, 1 << 63, 999, dtype=np.uint64) * 2, np.sort(rng.integers(-50, 1 << 40, 999))
    found = set()
    for k, g, n in jaccard_join._pack(jaccard_join._place(grams, 7), 7, grams, nodes):
        again = np.cumsum(np.frombuffer(jaccard_join._deltas(n), np.int64))
        assert again.tolist() == np.frombuffer(n, np.int64).tolist()
        back = jaccard_join._long(jaccard_join._short(g), k)
        assert ((back ^ np.frombuffer(g, np.uint64)) & np.uint64((1 << 48) - 1) == 0).all() and (back >> np.uint64(48) == k).all()
        found |= set(zip(np.frombuffer(g, np.uint64).tolist(), again.tolist(), strict=True))
    assert found == set(zip(grams.tolist(), nodes.tolist(), strict=True))


def test_jaccard_pairs_deal_their_rows_once(spark, monkeypatch):
    """Both sides of the join that makes the last pairs are one shuffle."""
    shared = prose(1, 80)
    docs = spark.createDataFrame([(i, f"{shared} {prose(i + 100, 20)}") for i in range(30)], "doc_id long, text string")
    plans, write = [], jaccard_join.materialize

    def watched(df, label, *more):
        if label == "pairs":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label, *more)

    monkeypatch.setattr(jaccard_join, "materialize", watched)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = jaccard_join.jaccard_components(docs).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.doc_id: r.component_id for r in found} == {i: i for i in range(30)}
    # other parts of the plan are used again too: it is the rows with their entries that count
    assert "array_intersect" in plans[-1] and any("ReusedExchange" in line and "own#" in line and "gram#" in line for line in plans[-1].splitlines())
