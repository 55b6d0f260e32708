"""Token alignment against a plain restatement with the tokenizers' own libraries."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattline.llm import bpe, token_alignment
from wattline.llm.token_alignment import ByteTokenizer, PieceTokenizer, Side, align, align_texts

from .conftest import SCHEMA, edge_rows, prose

vocabularies = pytest.importorskip("public_tokenizers")
A, B = vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model")
ODD = [
    "Hello wörld 漢字 🙂", "a▁b", "▁", " two  spaces\n\n", "<|endoftext|> x</s><s><unk>", "\x00\x01 nul", "<0x41>", "   ", "\t", "x" * 500, "ab" * 300,
    "naïve ́ combining", "漢" * 40, "ａｂｃ ﬁ", " nbsp　wide", "don't I'LL 12345 3.14", "\r\n\r\n", "🙂🙃" * 20,
]


def plain_tokens(text):
    """Ids and bytes of both sides, by the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    library, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    shown = bpe.byte_symbols()
    a = [(i, bytes(shown[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids]
    pieces = [(i, model.id_to_piece(i)) for i in model.encode(text)]
    b = [(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and p.endswith(">") else p.replace("▁", " ").encode()) for i, p in pieces]
    return a, b


def by_hand(texts):
    found, held = [], []
    for text in texts:
        groups, a, b = [], [], []
        if text:
            a, b = plain_tokens(text)
            wanted = (" " + text).encode()
            if b"".join(t for _, t in a) != wanted or b"".join(t for _, t in b) != wanted:
                a, b = [], []
        ends = [{sum(len(t) for _, t in side[: k + 1]): k for k in range(len(side))} for side in (a, b)]
        at = [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            groups.append(([i for i, _ in a[at[0] : ends[0][end] + 1]], [i for i, _ in b[at[1] : ends[1][end] + 1]]))
            at = [ends[0][end] + 1, ends[1][end] + 1]
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        found.append((len(a), len(b), groups, links))
        held.append(links)
    counts = Counter(pair for links in held for pair in links)
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for n_a, n_b, groups, links in found:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        best = sum(n for pair, n in links.items() if counts[pair] == top[pair[0]])
        out.append((n_a, n_b, len(groups), sum(links.values()), best, sum(n * counts[pair] for pair, n in links.items()), digest, written))
    return out


@pytest.mark.parametrize("most", [1 << 20, 40, 0])
def test_equals_the_restatement(spark, most):
    rows = [(k, t, "en", "s", 1) for k, t in enumerate([None, "", *ODD, *ODD[:3], *(prose(s, 40) for s in range(6))])]
    rows += [(None, "a b c", "en", "s", 1), (1, "a b c", "en", "s", 1), (1, "a b c", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", *[F.lit(1).alias(c) for c in ("key", "rid", "pair", "n", "links", "groups", "top")])
    expected = by_hand([r[1] for r in rows])
    found = align_texts(docs, A, B, keep_groups=True, most_pairs=most)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr((r[0], *e)) for r, e in zip(rows, expected, strict=True))


def test_slices_of_large_groups(monkeypatch):
    sides = Side(ByteTokenizer(A)), Side(PieceTokenizer(B))
    texts = [*ODD, None, prose(4, 200), ""]
    whole = align(texts, *sides)
    monkeypatch.setattr(token_alignment, "PAIRS_AT_ONCE", 3)
    sliced = align(texts, *sides)
    assert all(list(map(str, whole[c])) == list(map(str, sliced[c])) for c in whole)


def test_counts_are_flushed_when_they_grow(spark, monkeypatch):
    aligned = spark.createDataFrame([([1, 2, 3],), ([2, 3, 9],), ([],), ([3],)], "pairs array<long>").coalesce(1)
    monkeypatch.setattr(token_alignment, "PAIRS_AT_ONCE", 2)
    assert {r.pair: r.n for r in token_alignment.pair_counts(aligned).collect()} == {1: 1, 2: 2, 3: 3, 9: 1}


def test_very_long_runs():
    sides = Side(ByteTokenizer(A)), Side(PieceTokenizer(B))
    for text in (" " * 300_000, "a" * 100_000 + "!", "\n" * 50_000):
        found = align([text], *sides)
        assert found["n_a"][0] >= found["n_groups"][0] > 0 and found["n_links"][0] >= found["n_groups"][0]


def test_edges_and_empty_table(spark, edge_docs, no_docs):
    found = align_texts(edge_docs, A, B)
    assert found.count() == len(edge_rows()) and found.where("n_a > 0 and groups_sha256 = ''").count() == 0
    assert align_texts(no_docs, A, B).collect() == []


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        ByteTokenizer(vocabularies.path("word_bpe_49k.json"))
