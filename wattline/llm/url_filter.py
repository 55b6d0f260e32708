"""URL rules indexed by their rarest literal token.

A rule is a pattern in the syntax of filter lists. Every word of letters and digits that any URL must hold to fit the pattern is a literal token
of the rule; the rule is filed under the one that is rarest among the URLs to judge. The tokens of a URL fetch the rules filed under them,
and only these run their regular expressions. So the work per URL does not grow with the rules, unless they share their rarest token.

Patterns work on the target: the host in lower case, then the rest of the URL up to ``#``.

* ``||`` at the start: a host or any of its subdomains begins here; ``|`` at the start or end: the target does.
* ``*``: any characters. ``^``: one character other than letters, digits and ``_-.%``, or the end. All else stands for itself.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.storage import materialize

#: Rules and bytes of patterns that go to every task; more are joined to the tokens of the URLs instead.
MOST_RULES, MOST_BYTES = 200_000, 16 << 20
#: Copies of a joined rule, over which the URLs of a frequent token are spread.
SALTS = 32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(UPPER, LOWER)
_TOKEN = re.compile("[A-Za-z0-9]+")
_SEPARATOR = r"(?:[^A-Za-z0-9_\-.%]|\Z)"


class Rule(NamedTuple):
    """A pattern and what it decides. A lower tier wins, then the longer pattern, then block, then the pattern's order."""

    pattern: str
    verdict: str
    name: str | None = None
    tier: int = 0


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with its subdomains and all paths that start with ``path``."""
    return Rule(f"||{host}{path}", verdict, host + path)


#: What is blocked where no host rule fits; a fixed choice of this library.
JUNK_RULES = tuple(
    Rule(pattern, "block", None, 1)
    for pattern in (
        "||spam-farm.", "||cheap-pills.", "||free-casino.", "||adserver.", "||doubleclick.", "/wp-login.", "/wp-admin/", "/cgi-bin/",
        "/login^", "/signin^", "/logout^", "/cart^", "/checkout^", "/xmlrpc.", "^phpsessid=", "^sessionid=",
    )
)


def parts(pattern: str) -> tuple[str, str, str]:
    """The anchors of a pattern and what lies between: start, body, end."""
    start = "||" if pattern.startswith("||") else "|" if pattern.startswith("|") else ""
    body = pattern[len(start) :]
    end = "|" if body.endswith("|") else ""
    return start, body[: len(body) - len(end)], end


def to_regex(pattern: str) -> str:
    """The regular expression of a pattern, to be searched in a target."""
    start, body, end = parts(pattern)
    signs = {"*": "(?s:.*)", "^": _SEPARATOR}
    head = {"||": r"\A(?:[^/?#]*\.)?", "|": r"\A", "": ""}[start]
    return head + "".join(signs.get(c) or re.escape(c) for c in body) + (r"\Z" if end else "")


def literal_tokens(pattern: str) -> list[str]:
    """Lower-case words that are whole words of every target that fits: with a border of their own on both sides."""
    start, body, end = parts(pattern)
    found = []
    for match in _TOKEN.finditer(body):
        a, b = match.span()
        left = body[a - 1] != "*" if a else bool(start)
        right = body[b] != "*" if b < len(body) else bool(end)
        if left and right:
            found.append(match.group().translate(_TO_LOWER))
    return sorted(set(found))


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and target of a URL; empty where it is null or has no ``://``."""

    def cut(pattern: str) -> Column:
        return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://" + pattern, 1), F.lit(""))

    host = F.translate(cut("([^/?#]*)"), UPPER, LOWER)
    return host, cut("[^/?#]*([^?#]*)"), F.concat(host, cut("[^/?#]*([^#]*)"))


def target_tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(target, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0)))


def file_rules(targets: DataFrame, rules: DataFrame, few: bool = False) -> DataFrame:
    """The rules with the ``token`` they are filed under: of their literal tokens the one that fewest of ``targets`` hold, '' without any.

    Counts cover all targets and are combined before they move. If the rules are known to be ``few``, only their tokens are counted.
    """
    words = rules.select("place", F.explode("tokens").alias("token"))
    wanted = words.select("token").distinct()
    held = targets.select(F.explode(target_tokens(F.col("target"))).alias("token"))
    if few:
        held = held.join(F.broadcast(wanted), "token", "left_semi")
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = words.join(counts, "token", "left").groupBy("place").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
    return rules.join(rarest, "place", "left").select("place", "pattern", F.coalesce("best.token", F.lit("")).alias("token"))


def _order(rule: Rule) -> tuple:
    return rule.tier, -len(rule.pattern), rule.verdict != "block", rule.pattern, rule.verdict, rule.name or ""


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url", key: str = "page_id", most_rules: int = MOST_RULES
) -> DataFrame:
    """One row per page: key, ``host``, ``path``, ``rule`` (the name of the winning rule), ``verdict``, ``pattern`` (of the winning rule).

    Of the rules that fit a URL the lowest tier wins, then the longest pattern, then block before allow. Without any, ``rule`` and ``pattern``
    are null and ``verdict`` is ``default``. Null URLs and URLs without ``://`` have an empty host, path and target, and so fit
    only patterns that fit nothing at all. Rows keep their number, also with equal or null keys; other columns are not looked
    at; an empty table gives an empty result, no rules give ``default``.

    The index goes to the tasks while the rules are within ``most_rules`` and ``MOST_BYTES``: no row moves. Beyond that the tokens of the URLs are joined to it,
    salted, since one token may be in most URLs; rules without a literal token are then tried on all URLs in the same way.
    """
    spark = pages.sparkSession
    ranked = sorted(set(rules), key=_order)
    host, path, target = split_url(F.col(url))
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), target.alias("target"))
    table = spark.createDataFrame(
        [(place, r.pattern, literal_tokens(r.pattern)) for place, r in enumerate(ranked)], "place int, pattern string, tokens array<string>"
    )
    few = len(ranked) <= most_rules and sum(len(r.pattern) for r in ranked) <= MOST_BYTES
    index = file_rules(rows, table, few)
    best = _by_index(rows, index) if few else _by_join(rows, index)
    told = spark.createDataFrame(
        [(place, r.name, r.verdict, r.pattern) for place, r in enumerate(ranked)], "place int, rule string, verdict string, pattern string"
    )
    told = F.broadcast(told) if few else told
    return best.join(told, "place", "left").select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"), "pattern"
    )


def _by_index(rows: DataFrame, index: DataFrame) -> DataFrame:
    """The strongest rule of each row (``place``, null for none), by an index in every task."""
    filed: dict[str, list[tuple[int, str]]] = {}
    for row in index.orderBy("place").collect():
        filed.setdefault(row.token, []).append((row.place, to_regex(row.pattern)))
    shared = rows.sparkSession.sparkContext.broadcast(filed)
    key_type = rows.schema["key"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        known = {token: [(place, re.compile(regex)) for place, regex in found] for token, found in shared.value.items()}
        free = known.get("", [])
        for batch in batches:
            places = []
            for text in batch.column("target").to_pylist():
                found = list(free)
                for token in set(_TOKEN.findall(text.translate(_TO_LOWER))):
                    found += known.get(token, ())
                # the strongest first: the first that fits decides
                found.sort(key=lambda rule: rule[0])
                places.append(next((place for place, regex in found if regex.search(text)), None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("host"), batch.column("path"), pa.array(places, pa.int32())], ["key", "host", "path", "place"]
            )

    return rows.mapInArrow(run, f"key {key_type}, host string, path string, place int")


def _by_join(rows: DataFrame, index: DataFrame) -> DataFrame:
    """The same by a join of tokens, for rules that do not fit into a task."""
    rows = materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "urls")
    salt = F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int")
    tokens = rows.select("rid", "target", salt.alias("salt"), F.explode(F.array_append(target_tokens(F.col("target")), F.lit(""))).alias("token"))
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = tokens.join(copies, ["token", "salt"]).select("rid", "target", "place", "pattern")

    def run(batches):
        import pyarrow as pa

        last, regex = None, None
        for batch in batches:
            fits = []
            for text, pattern in zip(batch.column("target").to_pylist(), batch.column("pattern").to_pylist(), strict=True):
                if pattern != last:
                    last, regex = pattern, re.compile(to_regex(pattern))
                fits.append(regex.search(text) is not None)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("place")], ["rid", "place"]).filter(pa.array(fits, pa.bool_()))

    best = met.mapInArrow(run, "rid long, place int").groupBy("rid").agg(F.min("place").alias("place"))
    return rows.join(best, "rid", "left").select("key", "host", "path", "place")
