"""BPE, fingerprints, licenses, mixing, classifiers and archives."""

import gzip
import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm import bpe, fingerprints, license_scan, mixing, rule_quality, toxicity, warc
from wattline.storage import scratch_path

from .conftest import SCHEMA, edge_rows, prose

VOCABULARY = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_equals_the_library(edge_docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    expected = []
    for doc_id, text, *_ in edge_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), ids, sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    found = bpe.encode_texts(edge_docs, VOCABULARY).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids, r.ids_sha256, r.decoded_sha256) for r in found), key=repr) == sorted(expected, key=repr)
    assert sorted(r.decoded for r in found) == sorted(t or "" for _, t, *_ in edge_rows())


def test_bpe_odd_strings():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    encoder = bpe.Encoder(bpe.Vocabulary(open(VOCABULARY, encoding="utf-8").read()))
    texts = ["a" * 999, "  \n\n  x", "  ", "don't we'll I'M", "٣٤٥ ½", "áe", "\x00\x01", "<|endoftext|><|endoftext|>", "<|endoftext", "abababab" * 50, "  　y"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == text


def test_fingerprints_edges(spark, edge_docs):
    found = {(r.doc_id, r.edited_sha256): r for r in fingerprints.fingerprint_texts(edge_docs).collect()}
    # the order the operator defines: key, nulls last, then the hash of the text
    ordered = [r.text or "" for r in edge_docs.select("doc_id", "text").orderBy(F.col("doc_id").isNull(), "doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    ids = [r.doc_id for r in edge_docs.select("doc_id", "text").orderBy(F.col("doc_id").isNull(), "doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    prints = {}
    for k, text in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)]
        quarter = len(text) // 4
        r = found[(ids[k], sha(text[: len(text) - quarter] + after[:quarter]))]
        assert r.n_chars == len(text)
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert r.fingerprint == fingerprints.fingerprint_text(fingerprints.digests([text.encode()])[0])
        assert r.edited_fingerprint == fingerprints.fingerprint_text(fingerprints.digests([fingerprints.edited(text, after).encode()])[0])
        own, other, ahead = (fingerprints.digests([t.encode()])[0] for t in (text, fingerprints.edited(text, after), after))
        assert r.near_edited == pytest.approx(fingerprints.likeness(own, other)) and r.near_next == pytest.approx(fingerprints.likeness(own, ahead))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert prints[""] == "" and len(found) >= len(set(ordered))


def test_fingerprints_tell_apart():
    texts = [prose(k, 400).encode() for k in range(30)]
    changed = [t[: len(t) * 3 // 4] + texts[(k + 1) % 30][: len(t) // 4] for k, t in enumerate(texts)]
    a, b = fingerprints.digests(texts), fingerprints.digests(changed)
    near = [fingerprints.likeness(x, y) for x, y in zip(a, b, strict=True)]
    far = [fingerprints.likeness(x, y) for x, y in zip(a, a[1:], strict=False)]
    assert min(near) > 0.4 > max(far) and all(fingerprints.likeness(x, x) == 1.0 for x in a)


def test_window_entropy():
    raw = np.random.default_rng(1).integers(97, 105, 400).astype(np.uint8)
    found = fingerprints.window_entropies(raw)
    for k in range(len(found)):
        p = np.bincount(raw[k : k + 64])
        p = p[p > 0] / 64
        assert found[k] == pytest.approx(-(p * np.log2(p)).sum(), abs=1e-6)


def test_mixing_edges(edge_docs):
    found = mixing.mix_sources(edge_docs, (3.0, 1.0, 2.0), 1.5, 2.0).collect()
    assert len(found) == len(edge_rows())
    assert sorted(((r.doc_id, r.size) for r in found), key=repr) == sorted(((i, len((t or "").encode().split())) for i, t, *_ in edge_rows()), key=repr)
    sizes, weights = {}, dict(zip(["", "src0", "src1", "src2", "src3", None], [3, 1, 2] * 2, strict=True))
    for _, t, _, s, _ in edge_rows():
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    # reshare until no target is above its limit
    whole, target, open_ = 1.5 * sum(sizes.values()), {}, set(sizes)
    while open_:
        level = (whole - sum(target.values())) / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level >= 2 * sizes[s]}
        if not full:
            target |= {s: weights[s] * level for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
    again = mixing.mix_sources(edge_docs, (3.0, 1.0, 2.0), 1.5, 2.0).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_mixing_hits_targets_and_repeats_rows(spark):
    rows = [(i, prose(i, 5 + i % 40), "en", "hot" if i % 3 == 0 else f"s{i % 4}", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    drawn = mixing.mix_sources(docs, (3.0, 1.0, 2.0), 1.5, 2.0)
    for r in drawn.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.sum("copies").alias("copies"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect():
        assert r.taken == pytest.approx(r.target, abs=60)
        # one integer border per expected copy
        assert abs(r.copies - r.target / r["size"] * r.n) <= 1
    mixed = mixing.repeat_rows(docs, drawn)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r.copies for r in drawn.collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == counts


def test_repeat_rows_of_one_key(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c")], "doc_id long, text string")
    drawn = spark.createDataFrame([(1, 2), (1, 1), (None, 1), (None, 2)], "doc_id long, copies long")
    assert mixing.repeat_rows(docs, drawn).count() == 6


def labelled_rows(n=600):
    rows = []
    for i in range(n):
        words = prose(i + 1, 30 + i % 50).split()
        bad = i % 5 == 0
        if bad:
            words[len(words) // 2] = ("vequ", "moronic", "Loweischaft")[i % 3] + words[0]
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_learns_and_scores(spark, edge_docs):
    rows = labelled_rows()
    train = spark.createDataFrame([r for r in rows if r[0] % 2], "key long, text string, label int")
    model = toxicity.fit_toxicity(train)
    test = spark.createDataFrame([(r[0], r[1], r[2]) for r in rows if not r[0] % 2], "doc_id long, text string, score int")
    found = toxicity.score_toxicity(test, model).select("row.*", F.col("score").alias("p"), "predicted").collect()
    right = [r.predicted == r.score for r in found]
    assert np.mean(right) > 0.97
    edge = toxicity.score_toxicity(edge_docs, model)
    assert edge.count() == len(edge_rows())
    scores = edge.select("row.text", "score").collect()
    assert all(0 <= r.score <= 1 for r in scores)
    assert len({r.score for r in scores if not r.text}) == 1


def test_classifiers_without_two_labels(spark, no_docs):
    one = spark.createDataFrame([(1, "text", 1), (2, None, 1), (3, "x", None)], "key long, text string, label int")
    none = one.where("false")
    docs = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    for rows, share in ((one, 3 / 4), (none, 1 / 2)):
        assert [r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(rows)).collect()] == pytest.approx([share] * 2)
        assert [r.score for r in rule_quality.score_quality(docs, rule_quality.fit_rules(rows)).collect()] == pytest.approx([share] * 2)
    assert toxicity.score_toxicity(no_docs, toxicity.fit_toxicity(none)).count() == 0
    assert rule_quality.score_quality(no_docs, rule_quality.fit_rules(none)).count() == 0


def test_held_out(spark):
    import zlib

    ids = [*range(50), -4, None]
    found = spark.createDataFrame([(i,) for i in ids], "i long").select("i", toxicity.held_out(F.col("i"), 3, 1).alias("h")).collect()
    assert all(r.h == (r.i is not None and zlib.crc32(str(r.i).encode()) % 3 == 1) for r in found)


def test_statistics():
    texts = ["", "Ab 12!!\nAb 12!!\n", "é|é"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    borders = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]
    found = [dict(zip(rule_quality.STATISTICS, row, strict=True)) for row in rule_quality.text_statistics(raw, borders)]
    assert not any(found[0].values())
    second = found[1]
    assert second["log_words"] == pytest.approx(np.log1p(4)) and second["mean_word"] == 3.0
    assert second["upper_share"] == 2 / 16 and second["digit_share"] == 4 / 16 and second["mark_share"] == 4 / 16
    assert second["repeated_words"] == 0.5 and second["repeated_lines"] == 0.5
    assert found[2]["pipe_share"] == 1 / 5 and found[2]["high_share"] == 4 / 5


def test_quality_rules(spark, edge_docs):
    rows = [(i, prose(i, 20 + i % 30) if i % 3 else prose(i, 20 + i % 30).upper().replace(" ", "!! "), int(i % 3 > 0)) for i in range(600)]
    train = spark.createDataFrame([r for r in rows if r[0] % 2], "key long, text string, label int")
    ensemble = rule_quality.fit_rules(train, trees=5)
    assert 0 < len(ensemble.rules) < 60
    test = spark.createDataFrame([r for r in rows if not r[0] % 2], "doc_id long, text string, label int")
    scored = rule_quality.score_quality(test, ensemble).select("row.label", "score", "predicted").collect()
    assert np.mean([r.predicted == r.label for r in scored]) > 0.98
    # the compiled column says what the rules say one by one
    stats = rule_quality.with_statistics(test).limit(20).select(*rule_quality.STATISTICS, ensemble.score().alias("p")).collect()
    for r in stats:
        total = ensemble.intercept + sum(x.weight for x in ensemble.rules if all((r[n] <= t) if low else (r[n] > t) for n, low, t in x.terms))
        assert r.p == pytest.approx(1 / (1 + np.exp(-total)))
    assert rule_quality.score_quality(edge_docs, ensemble).count() == len(edge_rows())


def test_license_lines(spark, edge_docs):
    rows = [(i, f"{prose(i, 40)}\n{t}\n{prose(i + 50, 10)}") for i, t in enumerate(license_scan.TEMPLATES.values())]
    rows += [(50, "licensed UNDER the apache license version 2.0"), (51, "They licensed their song to a film."), (52, None), (53, "")]
    found = license_scan.scan_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.id: r.license for r in found} == dict(enumerate(license_scan.TEMPLATES)) | {50: "Apache-2.0"}
    assert all(r.line == 1 for r in found if r.id < 50)
    assert license_scan.scan_lines(edge_docs).count() == 0
    assert license_scan.scan_files(edge_docs, F.lit("a/b")).count() >= len(edge_rows())


def license_expected(rows, templates, least):
    """Every line against every template, without any filter."""
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    vocabulary = {w for t in templates.values() for w in words(t)}
    docs = Counter(w for _, t in rows for w in set(words(t or "")) & vocabulary)
    idf = {w: math.log((len(rows) + 1) / (docs[w] + 1)) + 1 for w in vocabulary}
    vector = lambda t: {w: n * idf.get(w, max(idf.values())) for w, n in Counter(words(t)).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    sides = {k: vector(t) for k, t in sorted(templates.items())}
    out = {}
    for i, text in rows:
        for line, passage in enumerate(re.split("\r\n|\r|\n", text or "")):
            v = vector(passage)
            best = max(((sum(x * s.get(w, 0) for w, x in v.items()) / length(v) / length(s), -n, k) for n, (k, s) in enumerate(sides.items())), default=(0,)) if v else (0,)
            if best[0] >= least:
                out[i, line] = best[2], round(best[0], 9)
    return out


@pytest.mark.parametrize("least", [0.75, 0.3])
def test_license_lines_without_a_telling_word(spark, least):
    rows = [(i, f"{prose(i, 40)} in use and the\n{t}") for i, t in enumerate(license_scan.TEMPLATES.values())] * 20
    wrapped = "use in source and binary forms, with or without modification, are permitted"
    rows += [(50 + k, t) for k, t in enumerate(["CC BY-NC 4.0", "x\nCC BY 4.0\ny", "Released under MIT", wrapped, "in the and of", "4 0", "released by", None, ""])]
    own = {"Own": "You may copy this work freely.", "Other": "the and the"}
    for templates in (license_scan.TEMPLATES, own):
        docs = [*rows, (90, "You may copy this work freely.")]
        found = license_scan.scan_lines(spark.createDataFrame(docs, "doc_id long, text string"), templates=templates, least=least).collect()
        expected = license_expected(docs, templates, least)
        assert {(r.id, r.line): (r.license, round(r.cosine, 9)) for r in found} == expected
        assert (90, 0) in expected if templates is own else {(50, 0), (51, 1), (52, 0), (53, 0)} <= expected.keys()


def test_license_inheritance(spark, no_docs):
    files = [("LICENSE", "MIT"), ("a/b/COPYING", "GPL-3.0"), ("a/x.py", None), ("a/b/c/d.py", None), ("a/b/own.py", "MIT"), ("/z/q.py", None), (None, None), ("top.py", None)]
    found = license_scan.inherit(spark.createDataFrame(files, "path string, license string")).collect()
    got = {r.path: (r.effective, r.inherited_from) for r in found}
    assert got == {
        "LICENSE": ("MIT", None), "a/b/COPYING": ("GPL-3.0", None), "a/x.py": ("MIT", ""), "a/b/c/d.py": ("GPL-3.0", "a/b"), "a/b/own.py": ("MIT", None),
        "/z/q.py": ("MIT", ""), None: (None, None), "top.py": ("MIT", ""),
    }
    assert license_scan.scan_files(no_docs, F.lit("a/b")).count() == 0


PAGES = [
    (1, "http://a/1", "x" * 150), (2, "http://a/2", "x" * 150), (3, None, "short"), (4, "http://a/4\r\nWARC-Type: evil", "short"), (5, "http://a/5", None), (6, "u", ""),
    (7, "u", "é" * 60), (8, "u", "é" * 60), (9, "u", "WARC/1.1\r\nWARC-Type: fake\r\n\r\n" * 20), (9, "u", "WARC/1.1\r\nWARC-Type: fake\r\n\r\n" * 20), (None, "u", "x" * 150),
    (None, "u", "n" * 200), (10, "u", "\r\n\r\n" * 40), (11, "u", prose(4, 20_000)),
]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = warc.archive_round_trip(pages).collect()
    expected = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if h == html and p is not None]
        again = len(body) >= 100 and bool(same) and page != min(same)
        expected.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", min(same) if again else None))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert warc.archive_round_trip(pages.where("false")).count() == 0


def plain_records(spark, n):
    pages = spark.createDataFrame([(i, f"http://a/{i}", prose(i, 30)) for i in range(n)], "page_id long, url string, html string")
    sized = warc.plan_revisits(pages, "html", "page_id")
    return [r[0].encode() for r in sized.orderBy("page_id").select(warc.warc_record(*[F.col(c) for c in ("page_id", "url", "html", "payload_bytes", "payload_digest", "owner")])).collect()]


def ids_and_gaps(data):
    ids, gaps, end = [], [], 0
    for start, stop, header, reason, _, _ in warc.salvage(data):
        if header is None:
            gaps.append((start, stop, reason))
        else:
            ids.append(header["warc-record-id"])
        end = max(end, stop)
    assert end == len(data)
    return ids, gaps


@pytest.mark.parametrize("packed", [False, True])
def test_salvage(spark, packed):
    records = plain_records(spark, 8)
    parts = [gzip.compress(r) for r in records] if packed else records
    names = [f"<urn:page:{i}>" for i in range(8)]
    assert ids_and_gaps(b"".join(parts)) == (names, [])
    # one byte of a record's content
    broken = bytearray(parts[3])
    broken[len(broken) // 2] ^= 0x5A
    ids, gaps = ids_and_gaps(b"".join([*parts[:3], bytes(broken), *parts[4:]]))
    begin = sum(map(len, parts[:3]))
    assert ids == names[:3] + names[4:] and gaps[0][0] == begin and gaps[-1][1] == begin + len(parts[3])
    # a cut record, junk between records, junk at both ends, a cut end
    ids, gaps = ids_and_gaps(b"".join([*parts[:2], parts[2][: len(parts[2]) // 2], *parts[3:]]))
    assert ids == names[:2] + names[3:] and len(gaps) == 1
    ids, gaps = ids_and_gaps(b"junk\x1f\x8b\x08junk" + parts[0] + b"\x00" * 99 + parts[1] + b"WARC/1.1\r\nnothing")
    assert ids == names[:2] and len(gaps) == 3
    ids, gaps = ids_and_gaps(b"".join(parts)[:-40])
    assert ids == names[:7] and gaps[-1][1] == len(b"".join(parts)) - 40
    assert ids_and_gaps(b"") == ([], [])


def test_salvage_inside_a_member(spark):
    records = plain_records(spark, 60)
    names = [f"<urn:page:{i}>" for i in range(60)]
    after = gzip.compress(records[0])
    for level in (0, 6):
        whole = gzip.compress(b"".join(records), level)
        assert ids_and_gaps(whole) == (names, [])
        # cut at its end, with and without a member behind it
        for cut in (4, 40, len(whole) // 2):
            ids, gaps = ids_and_gaps(whole[:-cut])
            assert ids == names[: len(ids)] and len(ids) >= (30 if cut > 40 else 57) - 5
            assert len(gaps) == 1 and 0 < gaps[0][0] < gaps[0][1] == len(whole) - cut and gaps[0][2] == "gzip member truncated"
            ids, gaps = ids_and_gaps(whole[:-cut] + after)
            assert ids[: 25] == names[:25] and ids[-1] == names[0] and gaps[-1][1] == len(whole) - cut
        # damaged in its middle: a byte that inflates to another one, and a block that does not inflate
        middle = len(whole) // 2
        for damage in (bytes([whole[middle] ^ 0x5A]), b"\xff" * 600):
            broken = whole[:middle] + damage + whole[middle + len(damage) :]
            for data in (broken, after + broken + after):
                ids, gaps = ids_and_gaps(data)
                own = ids[1:-1] if data is not broken else ids
                assert own[:15] == names[:15] and len(own) == len(set(own)) < 60 and gaps
                assert data is broken or ids[0] == ids[-1] == names[0]
    # a record without a digest is not trusted in a damaged member
    bare = [b"WARC/1.1\r\nWARC-Type: metadata\r\nWARC-Record-ID: <urn:bare>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", *records[:2]]
    whole = gzip.compress(b"".join(bare))
    assert ids_and_gaps(whole[:-3])[0] == ["<urn:bare>", names[0]]
    assert ids_and_gaps(whole[:-8] + bytes(8))[0] == names[:2]


def test_salvage_reads_files(spark):
    import pathlib

    records = plain_records(spark, 4)
    folder = pathlib.Path(scratch_path(spark, "salvage").removeprefix("file:"))
    folder.mkdir(parents=True)
    (folder / "a.warc").write_bytes(records[0] + b"garbage" + records[1])
    (folder / "b.warc.gz").write_bytes(gzip.compress(records[2]) + gzip.compress(records[3])[:-9])
    (folder / "empty.warc").write_bytes(b"")
    found = warc.read_archives(spark, str(folder)).orderBy("archive", "offset").collect()
    assert [(r.kind, r.warc_type, r.reason) for r in found] == [
        ("record", "response", None), ("gap", None, "no version line"), ("record", "response", None), ("record", "response", None), ("gap", None, "gzip member truncated"),
    ]
    assert found[1].offset == len(records[0]) and found[1].length == 7 and bytes(found[0].payload).decode() == prose(0, 30)


def test_salvage_places_do_not_overlap(spark):
    records = plain_records(spark, 3)
    content = b"noise" + records[0] + b"garbage" + records[1] + records[2][:-30]
    data = gzip.compress(records[0]) + gzip.compress(content) + b"junk" + records[2]
    found = list(warc.walk(data))
    member = [f for f in found if f[0] == len(gzip.compress(records[0]))]
    inner = sorted(f[2] for f in member)
    assert inner[0][0] == 0 and inner[-1][1] == len(content) and all(a[1] == b[0] for a, b in zip(inner, inner[1:], strict=False))
    assert [f[3] is not None for f in sorted(member, key=lambda f: f[2])] == [False, True, False, True, False]
    outer = sorted({f[:2] for f in found})
    assert outer[0][0] == 0 and outer[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(outer, outer[1:], strict=False))


def test_salvage_flipped_header_bytes(spark):
    """What a flipped byte of a header may leave undetected, by field: only changes that leave a valid header."""
    records = plain_records(spark, 3)
    head = records[1].index(b"\r\n\r\n")
    accepted = Counter()
    for at in range(head):
        for mask in (0x01, 0x5A, 0x10):
            broken = bytearray(records[1])
            broken[at] ^= mask
            ids, gaps = ids_and_gaps(records[0] + bytes(broken) + records[2])
            assert ids[0] == "<urn:page:0>" and ids[-1] == "<urn:page:2>" and len(ids) + len(gaps) >= 3
            if len(ids) == 3:
                line = records[1][:at].count(b"\r\n")
                accepted[records[1].split(b"\r\n")[line].split(b":")[0].decode()] += 1
    assert set(accepted) <= {"WARC/1.1", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "Content-Type"}, accepted
    assert accepted["WARC/1.1"] <= 1 and accepted["Content-Type"] <= 2, accepted


def test_salvage_takes_linear_time():
    import time

    begin = time.perf_counter()
    ids, gaps = ids_and_gaps(b"WARC/1.1\r\n" * 100_000 + b"WARC/1.1\r\nWARC-Type: response\r\n" * 30_000)
    # the search that took 2.6 s for 220 KB would take minutes for these 2 MB
    assert not ids and len(gaps) == 1 and time.perf_counter() - begin < 20


def test_toxicity_equals_a_restatement(spark):
    """Counts, ratios and scores again, in plain Python over n-grams as strings; slots do not collide here."""
    rows = labelled_rows(200)
    model = toxicity.fit_toxicity(spark.createDataFrame(rows, "key long, text string, label int"), bits=26)
    sets = [{t.lower()[k : k + n] for n in toxicity.SIZES for k in range(len(t) - n + 1)} for _, t, _ in rows]
    slot = {g: int(toxicity.gram_slots(toxicity.code_points(g), (len(g),), 26)[0]) for s in sets for g in s}
    toxic, other = (sum(1 for r in rows if r[2] == label) for label in (1, 0))
    with_toxic = Counter(g for s, r in zip(sets, rows, strict=True) if r[2] for g in s)
    with_any = Counter(g for s in sets for g in s)
    kept = {}
    for g, n in with_any.items():
        p, q, both = with_toxic[g] / toxic, (n - with_toxic[g]) / other, n / (toxic + other)
        error = math.sqrt(both * (1 - both) * (1 / toxic + 1 / other))
        if abs(p - q) / max(error, 1e-9) >= toxicity.LEAST_DEVIATION:
            kept[g] = math.log((with_toxic[g] + 1) / (toxic + 2)) - math.log((n - with_toxic[g] + 1) / (other + 2))
    assert sorted(slot[g] for g in kept) == model.slots.tolist()
    # the fit is at its optimum: the gradient of the balanced, penalised loss is nothing
    place = {s: k for k, s in enumerate(model.slots.tolist())}
    x = np.zeros((len(rows), len(kept)))
    for k, s in enumerate(sets):
        for g in s & kept.keys():
            x[k, place[slot[g]]] = kept[g]
    ratio = np.zeros(len(kept))
    for g, r in kept.items():
        ratio[place[slot[g]]] = r
    w, y = model.weights / ratio, np.array([r[2] for r in rows])
    score = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    weight = np.where(y == 1, len(rows) / (2 * toxic), len(rows) / (2 * other)) / len(rows)
    assert np.abs(x.T @ (weight * (score - y)) + toxicity.PENALTY * w).max() < 2e-3
    places = model.places()
    found = [model.score(toxicity.code_points(t), places) for _, t, _ in rows]
    assert found == pytest.approx(score.tolist(), abs=1e-9)


def test_toxicity_windows_are_of_characters():
    assert len(toxicity.gram_slots(toxicity.code_points("漢字漢字漢"), (3,))) == 3
    assert toxicity.gram_slots(toxicity.code_points("ÉCOLE")).tolist() == toxicity.gram_slots(toxicity.code_points("école")).tolist()
    longer, shorter = toxicity.gram_slots(toxicity.code_points("abcdef"), (3, 5)), toxicity.gram_slots(toxicity.code_points("abcde"), (5,))
    assert longer[4] == shorter[0] and len(longer) == 6


MIT_TEXT = """The MIT License (MIT)

Copyright (c) 2024 Foo Corp.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
APACHE_HEADER = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */
"""


def license_files():
    return [
        (1, MIT_TEXT), (2, "MIT License"), (3, "# SPDX-License-Identifier: Apache-2.0\nimport os\n" + prose(1, 200)), (4, "GNU GENERAL PUBLIC LICENSE\n  Version 3\n"),
        (5, APACHE_HEADER + prose(2, 300)), (6, "Released under the MIT License by Foo Corp."), (7, prose(3, 80) + "\r\nReleased under the MIT License.\r\n" + prose(4, 80)),
        (8, "// SPDX-License-Identifier: GPL-2.0-or-later"), (9, "# SPDX-License-Identifier: Unknown-9"), (10, "They licensed their song to a film."), (11, None), (12, ""), (None, "MIT License"),
        (13, "This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not distributed with this\n# file, You can obtain one at http://mozilla.org/MPL/2.0/."),
        (2, "MIT License"), (14, " \n".join(["word"] * 5000)), (15, "Permission granted to use this file " + prose(9, 30)),
    ]


def test_license_texts_headers_and_tags(spark):
    docs = spark.createDataFrame(license_files() * 3, "doc_id long, text string").select("*", F.lit("x").alias("license"), F.lit("y").alias("body"))
    found = license_scan.scan_passages(docs).collect()
    names = {r.id: r.license for r in found}
    assert names == {1: "MIT", 2: "MIT", 3: "Apache-2.0", 4: "GPL-3.0", 5: "Apache-2.0", 6: "MIT", 7: "MIT", 8: "GPL-2.0", 13: "MPL-2.0", None: "MIT"}
    assert len(found) == len(names) and all(0 < r.share <= 1 + 1e-9 for r in found)
    share = {r.id: r.share for r in found}
    # license files by their share of weight, whatever their length; sources with a header or a line are none
    assert {k for k, v in share.items() if v >= license_scan.FILE_SHARE} == {1, 2, 4, 6, 8, 13, None}
    plan = license_scan.scan_passages(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_passages_equal_a_restatement(spark):
    """Cosines, covers and shares again in plain Python."""
    rows = license_files()
    total = len(rows)
    split = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    vocabulary = {t for _, x in license_scan.LICENSE_TEXTS for t in split(x)}
    df = Counter(t for _, x in rows for t in set(split(x)) & vocabulary)
    idf = {t: math.log((total + 1) / (df[t] + 1)) + 1 for t in vocabulary}
    most = max(idf.values())
    weight = lambda words: {t: n * idf.get(t, most) for t, n in Counter(words).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    expected = {}
    for key, text in rows:
        paragraphs = [p for p in re.split(license_scan._BLANK_LINES, text or "") if re.search("[\r\n]", p.strip("\r\n"))]
        hits, words = [], set()
        for passage in [*re.split("\r\n|\r|\n", text or ""), *paragraphs]:
            own = weight(split(passage))
            best = None
            for name, template in sorted(license_scan.LICENSE_TEXTS, key=lambda x: x[0]):
                side = weight(split(template))
                cosine = sum(v * own.get(t, 0) for t, v in side.items()) / length(side) / (length(own) or 1)
                cover = math.sqrt(sum(v * v for t, v in side.items() if t in own)) / length(side)
                if (cosine >= 0.75 or (cosine >= 0.5 and cover >= 0.95)) and (best is None or cosine > best[0]):
                    best = cosine, name
            tag = re.search(license_scan.SPDX_TAG, passage) if not re.search("[\r\n]", passage) else None
            known = {n.lower(): n for n in license_scan.SPDX_NAMES}.get(tag[1].lower()) if tag else None
            for hit in [best, known and (1.0, known)]:
                if hit:
                    hits.append((-hit[0], hit[1]))
                    words |= set(split(passage))
        if hits:
            cosine, name = min(hits, key=lambda h: (round(h[0], 12), h[1]))
            everything = [idf.get(t, most) for t in split(text)]
            expected[key] = name, -cosine, sum(idf.get(t, most) for t in split(text) if t in words) / sum(everything)
    found = license_scan.scan_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.id: r.license for r in found} == {k: v[0] for k, v in expected.items()}
    for r in found:
        assert (r.cosine, r.share) == pytest.approx(expected[r.id][1:])


def test_license_scores_are_computed_once(spark):
    """A plan that repeats the terms of a passage in each place that names them took minutes for a few notices."""
    docs = spark.createDataFrame([(i, MIT_TEXT * 3) for i in range(40)], "doc_id long, text string")
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized(license_scan.scan_passages(docs)).count("regexp_extract_all") <= 4
    files = license_scan.scan_files(docs, F.lit("a/b"), file_share=license_scan.FILE_SHARE)
    assert optimized(files).count("regexp_extract_all") <= 4
    assert {(r.license, r.share >= license_scan.FILE_SHARE) for r in files.collect()} == {("MIT", True)}
    words = spark.createDataFrame([("b a b c a b".split(),), ([],)], "words array<string>")
    counted = [r[0] and {c.term: c.n for c in r[0]} for r in words.select(license_scan._counted(F.col("words"))).collect()]
    assert counted == [{"a": 2, "b": 3, "c": 1}, None]


def test_license_file_speaks_for_its_directory(spark, no_docs):
    rows = [(1, "a", MIT_TEXT * 20), (2, "a", prose(1, 50)), (3, "b", prose(2, 50)), (4, "a", APACHE_HEADER + prose(3, 200)), (5, "a/x", None), (None, "a", "")]
    docs = spark.createDataFrame(rows, "doc_id long, folder string, text string")
    path = F.concat_ws("/", "folder", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    found = {r.id: r for r in license_scan.scan_files(docs, path, file_share=license_scan.FILE_SHARE).collect()}
    assert {k: (r.effective, r.inherited_from) for k, r in found.items()} == {
        1: ("MIT", None), 2: ("MIT", "a"), 3: (None, None), 4: ("Apache-2.0", None), 5: ("MIT", "a"), None: ("MIT", "a")
    }
    assert found[1].path == "a/LICENSE.1" and found[4].path == "a/4" and len(found) == len(rows)
    assert license_scan.scan_files(no_docs, F.lit("a/b"), file_share=0.5).count() == 0


def test_long_texts_are_taken_in_blocks(monkeypatch):
    from wattline.llm import words

    text = prose(5, 4000) + " " + "long" * 900 + " é漢字 " + prose(6, 50)
    points = toxicity.code_points(text)
    whole = np.unique(toxicity.gram_slots(points))
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = words.word_spans(raw, np.array([0, len(raw)]))
    hashes = words.span_hashes(raw, starts, ends, fold=True)
    monkeypatch.setattr(toxicity, "BLOCK_POINTS", 100)
    monkeypatch.setattr(words, "_KEPT", 64)
    assert toxicity.distinct_slots(points, toxicity.SIZES, toxicity.BITS).tolist() == whole.tolist()
    assert words.span_hashes(raw, starts, ends, fold=True).tolist() == hashes.tolist()
    assert len(set(hashes.tolist())) == len({raw[a:b].tobytes().lower() for a, b in zip(starts, ends, strict=True)})
    assert toxicity.distinct_slots(points[:0], toxicity.SIZES, toxicity.BITS).tolist() == []


def test_encoder_keeps_decoded_bytes_only_where_they_differ(spark):
    import json

    from wattline.llm.batches import BATCH_BYTES, BATCH_SETTING, bound_batches

    symbols = {c: i for i, c in enumerate(bpe.byte_symbols())}
    file = {"model": {"vocab": symbols | {"ab": 256, "abc": 257}, "merges": ["a b", "ab c"]}, "added_tokens": [{"content": "<end>", "id": 300}]}
    encoder = bpe.Encoder(bpe.Vocabulary(json.dumps(file)))
    texts = ["abc cab \u00e9\u6f22 abcabc", "x<end>abc<end>", "", " \n"]
    assert [back for _, back in encoder.written_and_decoded(texts)] == texts
    # a second copy of every piece is what made the pipeline's last stage too large
    assert encoder.bytes == {}
    encoder = bpe.Encoder(bpe.Vocabulary(json.dumps(file)))
    encoder.vocabulary.bytes_of[257] = b"\xffz"
    got = list(encoder.written_and_decoded(texts))
    assert [back for _, back in got] == [t.replace("abc", "\ufffdz") for t in texts]
    assert [back for _, back in got] == [encoder.decode([int(i) for i in ids.split(",")] if ids else []) for ids, _ in got]
    assert BATCH_BYTES <= 4 << 20
    bound_batches(spark)
    assert spark.conf.get(BATCH_SETTING)
