"""The registered queries of this subpackage, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bpe, exact_dedup, fingerprints, jaccard_join, license_scan, mixing, prefix_trie, rule_quality, substring_dedup, token_alignment, toxicity, url_filter, warc
from wattline.llm.batches import bound_batches

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query(
    """
    WITH p AS (
      SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), o AS (SELECT payload_digest, min(page_id) AS owner FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN owner IS NULL OR owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN owner <> page_id THEN owner END AS refers_to
    FROM p LEFT JOIN o USING (payload_digest)
    """
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query()
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a project, a hundred ids are a directory, and a text that is little but a license speaks for its directory."""
    docs = table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.floor(F.col("doc_id") / 100).cast("string"))
    path = F.concat_ws("/", folder, F.concat(F.lit("text."), F.col("doc_id").cast("string")))
    found = license_scan.scan_files(docs, path, file_share=license_scan.FILE_SHARE)
    return found.withColumnRenamed("id", "doc_id")


@query(
    """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
      sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest", carry=False)
    return marked.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
    ), p AS (SELECT rid, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35
    ), h AS (SELECT rid, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM p
    ), b AS (SELECT rid, i FROM h QUALIFY count(*) OVER (PARTITION BY h) > 1
    ), c AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS j FROM b
    ), w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM d
    ), k AS (SELECT rid, string_agg(word, ' ' ORDER BY j) AS kept FROM w ANTI JOIN c USING (rid, j) GROUP BY rid
    ), n AS (SELECT rid, count(*) AS gone FROM c GROUP BY rid)
    SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k USING (rid) LEFT JOIN n USING (rid)
    """
)
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


#: Weights of the sources in turn, the share of all words that the mix takes, and the most copies of a source's words.
MIX_WEIGHTS, MIX_SHARE, MIX_CAP = (3.0, 1.0, 2.0), 1.5, 2.0


@query(
    r"""
    WITH s AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
    ), t AS (
      SELECT source, sum(size)::BIGINT AS source_size,
        [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM s GROUP BY source
    ), l AS (SELECT *, 2.0::DOUBLE * source_size AS lim, 1.5::DOUBLE * sum(source_size) OVER () AS whole FROM t
    ), f AS (
      SELECT *, (whole - (sum(lim) OVER o - lim)) / (sum(w) OVER () - sum(w) OVER o + w) AS level FROM l
      WINDOW o AS (ORDER BY lim / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)
    ), g AS (
      SELECT *, first_value(CASE WHEN w * level < lim THEN level END IGNORE NULLS) OVER (ORDER BY lim / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS set_level
      FROM f
    ), v AS (
      SELECT source, source_size, CASE WHEN set_level IS NULL THEN lim ELSE least(w * set_level, lim) END AS target,
        (('0x' || substr(md5('17:' || coalesce('s' || source, 'null')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE)::DECIMAL(34, 15) AS shift
      FROM g
    ), e AS (
      SELECT s.*, source_size, target, shift, (CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END)::DECIMAL(34, 15) AS expected
      FROM s JOIN v ON s.source IS NOT DISTINCT FROM v.source
    ), u AS (SELECT *, sum(expected) OVER (PARTITION BY source ORDER BY size DESC, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto FROM e
    ), c AS (SELECT *, (floor(upto + shift) - floor(upto - expected + shift))::BIGINT AS copies FROM u)
    SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM c
    """
)
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE, MIX_CAP)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


@query()
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False, decoded=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query()
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_texts(table(spark, sf_dir, "documents"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int) -> DataFrame:
    """Texts with labels that may be learnt from: key, text, label."""
    allowed = labels.where(~toxicity.held_out(F.col("doc_id"), parts, part)).select(
        F.col("doc_id").alias("label_id"), F.col(label).alias("label")
    )
    met = docs.join(allowed, F.col("doc_id") == F.col("label_id"))
    return met.select(F.col("doc_id").alias("key"), "text", "label")


@query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(labelled(docs, table(spark, sf_dir, "labels"), "toxic", 3, 1))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("row.doc_id", toxicity.held_out(F.col("row.doc_id"), 3, 1).alias("held_out"), "score", "predicted")


@query()
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ensemble = rule_quality.fit_rules(labelled(docs, table(spark, sf_dir, "labels"), "quality", 4, 2))
    scored = rule_quality.score_quality(docs.select("doc_id", "text"), ensemble)
    return scored.select("row.doc_id", toxicity.held_out(F.col("row.doc_id"), 4, 2).alias("held_out"), "score", "predicted")


@query(
    r"""
    WITH RECURSIVE crc AS (
      SELECT list_transform(range(256), lambda i : list_reduce(range(8), lambda c, k : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS tab
    ), said AS (
      SELECT conv_id, turn, md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
        len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS words
      FROM conversations WHERE conv_id IS NOT NULL
    ), heads AS (
      SELECT conv_id, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda x : ord(x)::BIGINT),
        lambda c, b : xor(tab[xor(c & 255, b) + 1], c >> 8), 4294967295), 4294967295) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM said), crc
    ), own AS (
      SELECT conv_id, any_value(h) AS h, list({'d': digest, 'w': words} ORDER BY turn NULLS FIRST, digest) AS ts
      FROM said JOIN heads USING (conv_id) GROUP BY conv_id
    ), built AS (
      SELECT o.conv_id, list_concat(coalesce(b.ts[1:o.h], []), o.ts[o.h + 1:]) AS ts FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
    ), rows_of AS (
      SELECT conv_id, d AS depth, len(ts) AS turns, array_to_string(list_transform(ts[1:d], lambda t : t.d), ',') AS node,
        CASE WHEN d > 0 THEN array_to_string(list_transform(ts[1:d - 1], lambda t : t.d), ',') END AS parent, coalesce(ts[d].w, 0) AS words
      FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM built)
    ), nodes AS (
      SELECT node, parent, depth, words, count(*) AS n_convs, min(conv_id) AS conv_id,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = turns), '')) AS ends_sha256
      FROM rows_of GROUP BY ALL
    ), kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
    ), weighed AS (
      SELECT n.*, coalesce(n_children, 0) AS n_children, (n_children IS NULL)::INT AS leaf, (n_convs - 1) * words AS saved FROM nodes n LEFT JOIN kids USING (node)
    ), up AS (
      SELECT node AS of, parent, leaf, saved FROM weighed
      UNION ALL SELECT u.parent, w.parent, u.leaf, u.saved FROM up u JOIN weighed w ON w.node = u.parent
    ), sums AS (SELECT of AS node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY of)
    SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
    FROM weighed w JOIN sums USING (node) LEFT JOIN nodes p ON p.node = w.parent
    """
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    heads = prefix_trie.Heads(conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, 3)
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), heads=heads).drop("node")


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.align_texts(table(spark, sf_dir, "documents"), *paths).drop("groups")


#: Host, path and verdict of the rules that decide first.
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


@query(
    r"""
    WITH junk(pattern, regex) AS (
      VALUES ('||spam-farm.', '^([^/?#]*\.)?spam-farm\.'), ('||cheap-pills.', '^([^/?#]*\.)?cheap-pills\.'),
        ('||free-casino.', '^([^/?#]*\.)?free-casino\.'), ('||adserver.', '^([^/?#]*\.)?adserver\.'),
        ('||doubleclick.', '^([^/?#]*\.)?doubleclick\.'), ('/wp-login.', '/wp-login\.'), ('/wp-admin/', '/wp-admin/'),
        ('/cgi-bin/', '/cgi-bin/'), ('/login^', '/login([^A-Za-z0-9_.%-]|$)'), ('/signin^', '/signin([^A-Za-z0-9_.%-]|$)'),
        ('/logout^', '/logout([^A-Za-z0-9_.%-]|$)'), ('/cart^', '/cart([^A-Za-z0-9_.%-]|$)'),
        ('/checkout^', '/checkout([^A-Za-z0-9_.%-]|$)'), ('/xmlrpc.', '/xmlrpc\.'), ('^phpsessid=', '[^A-Za-z0-9_.%-]phpsessid='),
        ('^sessionid=', '[^A-Za-z0-9_.%-]sessionid=')
    ), u AS (
      SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1) AS tail
      FROM pages
    ), r AS (
      SELECT *, host || tail AS target, CASE
        WHEN '.' || host LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN '.' || host LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN '.' || host LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN '.' || host LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
      FROM u
    ), j AS (
      SELECT target, arg_min(pattern, printf('%04d', 1000 - len(pattern)) || pattern) AS pattern
      FROM (SELECT DISTINCT target FROM r WHERE rule IS NULL) t JOIN junk ON regexp_matches(target, regex) GROUP BY target
    )
    SELECT page_id, host, path, rule,
      CASE WHEN rule IN ('net/', 'example.com/de/') OR (rule IS NULL AND pattern IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict,
      CASE WHEN rule IS NULL THEN pattern ELSE '||' || rule END AS pattern
    FROM r LEFT JOIN j USING (target)
    """
)
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [*(url_filter.host_rule(*rule) for rule in URL_RULES), *url_filter.JUNK_RULES]
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)
