"""License scan: TF-IDF cosine of license text to templates, then inheritance from the nearest ancestor directory.

Everything is DataFrame expressions. The vector space is the vocabulary of the templates, so a literal map from term to number
bounds what tasks hold; a passage's vector is sparse. Inverse document frequencies come from all documents. Lines are scored
unless the terms they share with each template are proven too light to reach the cosine asked for.

`scan_lines` takes every line as a passage, so a notice inside a long text is compared by itself. `scan_passages` takes paragraphs too, for headers and license
texts that are wrapped over lines, knows SPDX tags, and accepts a notice that names an owner if it has nearly all of a template. The share of a text's
weight that such passages have, and not its length, makes it a license file.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.storage import materialize

#: Usual one-line notices, by SPDX name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
}
# Titles, headers and characteristic paragraphs of usual licenses, as published.
LICENSE_TEXTS = (
    *TEMPLATES.items(),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "MIT License"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to
    deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of
    the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of
    the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software
    Foundation; either version 2 of the License, or (at your option) any later version."""),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software
    Foundation, either version 3 of the License, or (at your option) any later version."""),
    ("LGPL-2.1", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free
    Software Foundation; either version 2.1 of the License, or (at your option) any later version."""),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain
    one at http://mozilla.org/MPL/2.0/."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"""),
    ("BSD-3-Clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without
    specific prior written permission."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and
    this permission notice appear in all copies."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
#: The names that an SPDX tag may give.
SPDX_NAMES = tuple(sorted({name for name, _ in LICENSE_TEXTS} | {"BSD-2-Clause", "LGPL-3.0", "AGPL-3.0", "CC0-1.0", "Zlib", "BSL-1.0"}))
SPDX_TAG = r"(?i)SPDX-License-Identifier:\s*\(?([a-z0-9.-]+?)(?:-only|-or-later|\+)?(?:[^a-z0-9.+-]|$)"
#: A passage that has this much of a template's weight counts from a lower cosine on: what is left may be an owner.
LEAST_COVER, COVERED_COSINE = 0.95, 0.5
#: A text is a license file from this share of its weight in license passages on.
FILE_SHARE = 0.5
#: Lines without a word part paragraphs; marks of comments are no words.
_BLANK_LINES = r"(?:\r\n|\r|\n)(?:[^\r\nA-Za-z0-9]*(?:\r\n|\r|\n))+"
#: Cosine from which a passage counts as the license.
LEAST_COSINE = 0.75
#: File names that speak for their directory, in lower case.
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
#: Words of a notice, for callers that make paths; the scan itself does not depend on them.
TELLING = r"(?i)licen[cs]e|redistribution"
#: Keeps rounding from dropping a passage at the bound.
_SLACK = 1e-9
#: A term is a run of ASCII letters and digits, in lower case.
TERM = "[a-z0-9]+"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _template_terms(spark, templates: Mapping[str, str]) -> DataFrame:
    rows = spark.createDataFrame(sorted(templates.items()), "license string, template string")
    return rows.select("license", F.explode(terms(F.col("template"))).alias("term")).groupBy("license", "term").agg(F.count(F.lit(1)).alias("tf"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once for each row. Spark puts a column's expression in place of each mention of it that it merges or pushes down."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _dot(vector: Column, side: Column) -> Column:
    """Product of a sparse vector (array of term, w) with a map from term to number."""
    return F.aggregate(vector, F.lit(0.0), lambda a, x: a + x["w"] * F.coalesce(F.element_at(side, x["term"]), F.lit(0.0)))


def _literal(numbers: Mapping[str, float]) -> Column:
    return F.create_map(*[x for t, v in sorted(numbers.items()) for x in (F.lit(t), F.lit(float(v)))])


def _shared_part(distinct: Column, side: Mapping[str, float]) -> Column:
    """Squared length of the part of a unit vector that lies in the terms of ``distinct``."""
    squares = _literal({t: v * v for t, v in side.items()})
    return F.aggregate(F.array_intersect(distinct, F.array(*[F.lit(t) for t in side])), F.lit(0.0), lambda a, t: a + F.element_at(squares, t))


def passages(docs: DataFrame, key: Column, text: Column, starts: str) -> DataFrame:
    """Lines of every whole text that match ``starts`` in lower case: ``id``, ``line``, ``passage``. A line is up to LF, CR or both."""
    lines = docs.where(F.lower(text).rlike(starts)).select(key.alias("id"), F.posexplode(F.split(text, r"\r\n|\r|\n")).alias("line", "passage"))
    return lines.where(F.lower("passage").rlike(starts))


def needed_terms(sides: Mapping[str, Mapping[str, float]], least: float) -> list[str]:
    """Terms of which a passage needs one to reach the cosine ``least`` with any of ``sides`` (unit vectors by license).

    The cosine is at most the length of the part of the unit vector that lies in the shared terms (Cauchy-Schwarz). So the heaviest terms
    of a template are needed, up to where the others together are shorter than ``least``.
    """
    needed = set()
    for side in sides.values():
        rest = sum(v * v for v in side.values())
        for term, v in sorted(side.items(), key=lambda x: (-x[1], x[0])):
            if rest < least * least - _SLACK:
                break
            needed.add(term)
            rest -= v * v
    return sorted(needed)


def scan_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Mapping[str, str] = TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """Licenses found in whole texts: ``id``, ``line``, ``license``, ``cosine``; the best license of every line that reaches ``least``.

    Terms outside the templates weigh as much as the rarest term, so other words in a line lower its cosine. Ties go to the license
    that comes first by name. Null and empty texts have no line; repeated rows are found once for each row; null keys stay.
    """
    space = _Space(docs, text, list(templates.items()))
    found = passages(docs, F.col(key), F.col(text), space.starts(least))
    best = _let(terms(F.col("passage")), lambda words: F.when(_may_reach(words, space, least), _best(_scores(words, space))))
    best = found.select("id", "line", best.alias("best"))
    # written, so that no condition on the result is worked out by scoring again
    return materialize(best, "license-lines").where(F.col("best.cosine") >= least).select("id", "line", "best.license", "best.cosine")


class _Space:
    """The templates as unit vectors over their terms, with frequencies from all documents."""

    def __init__(self, docs: DataFrame, text: str, templates: list[tuple[str, str]]):
        spark = docs.sparkSession
        names = {str(k): name for k, (name, _) in enumerate(templates)}
        template = materialize(_template_terms(spark, {str(k): t for k, (_, t) in enumerate(templates)}), "license-terms")
        vocabulary = [r["term"] for r in template.select("term").distinct().orderBy("term").collect()]  # bounded by the templates
        known = F.array(*[F.lit(t) for t in vocabulary])
        counted = docs.select(F.explode(F.array_intersect(F.array_distinct(terms(F.coalesce(F.col(text), F.lit("")))), known)).alias("term"))
        frequency = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        total = docs.count()
        weights = template.select("term").distinct().join(frequency, "term", "left")
        weights = weights.select("term", (F.log(F.lit(total + 1.0) / (F.coalesce("df", F.lit(0)) + 1)) + 1.0).alias("idf"))
        weights = materialize(weights, "license-weights")
        self.idf = {r["term"]: r["idf"] for r in weights.collect()}  # bounded by the templates
        self.most = max(self.idf.values(), default=1.0)
        counts = template.collect()  # bounded by the templates
        #: (license, unit vector) by license name, then in the given order.
        self.sides: list[tuple[str, dict[str, float]]] = []
        for place in sorted(names, key=lambda k: (names[k], int(k))):
            own = {r["term"]: r["tf"] * self.idf[r["term"]] for r in counts if r["license"] == place}
            length = sum(v * v for v in own.values()) ** 0.5
            if own:
                self.sides.append((names[place], {t: v / length for t, v in sorted(own.items())}))

    def starts(self, least: float) -> str:
        """Pattern of the terms of which a passage needs one. Terms are ASCII, so its borders are those of a term.

        Few places of a text have a border before them, and at these a first letter leaves few terms to try.
        """
        needed: dict[str, list[str]] = {}
        for term in needed_terms({str(k): side for k, (_, side) in enumerate(self.sides)}, least):
            needed.setdefault(term[0], []).append(term[1:])
        tried = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in needed.items())
        return rf"(?:[^a-z0-9]|^)(?:{tried})(?![a-z0-9])" if least > 0 else TERM

    def weight(self, term: Column) -> Column:
        return F.coalesce(F.element_at(_literal(self.idf), term), F.lit(float(self.most)))


def _may_reach(words: Column, space: _Space, least: float) -> Column:
    """Whether the terms that a passage shares with some template are heavy enough for ``least``."""

    def any_of(distinct: Column) -> Column:
        return reduce(or_, [_shared_part(distinct, side) >= least * abs(least) - _SLACK for _, side in space.sides], F.lit(False))

    return _let(F.array_distinct(words), lambda distinct: (F.size(distinct) > 0) & any_of(distinct))


def _counted(words: Column) -> Column:
    """Each distinct word (``term``) and how often it stands in ``words`` (``n``), in time that grows with the words as sorting does."""

    def runs(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        first = F.filter(places, lambda k: (k == 0) | (F.get(ordered, k) != F.get(ordered, k - 1)))
        return _let(first, lambda at: F.transform(at, lambda k, i: F.struct(F.get(ordered, k).alias("term"), (F.coalesce(F.get(at, i + 1), F.size(ordered)) - k).alias("n"))))

    return F.when(F.size(words) > 0, _let(F.sort_array(words), runs))


def _scores(words: Column, space: _Space) -> Column:
    """Cosine, license and cover (the length of a template's vector in the terms that it shares with the passage) for every template."""

    def against(vector: Column, distinct: Column, norm: Column) -> Column:
        return F.array(
            *[F.struct((_dot(vector, _literal(side)) / norm).alias("cosine"), F.lit(name).alias("license"), F.sqrt(_shared_part(distinct, side)).alias("cover")) for name, side in space.sides]
        )

    def from_vector(vector: Column) -> Column:
        norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))
        return _let(norm, lambda length: _let(F.transform(vector, lambda x: x["term"]), lambda distinct: against(vector, distinct, length)))

    return _let(F.transform(_counted(words), lambda c: F.struct(c["term"].alias("term"), (c["n"] * space.weight(c["term"])).alias("w"))), from_vector)


def _best(scores: Column) -> Column:
    """Of the scores the highest cosine, the first by name in ties; null if there is none."""
    return _let(scores, lambda all_of: F.aggregate(all_of, F.get(all_of, F.lit(0)), lambda a, x: F.when(x["cosine"] > a["cosine"], x).otherwise(a)))


def scan_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = LICENSE_TEXTS, least: float = LEAST_COSINE,
    covered: float = COVERED_COSINE, cover: float = LEAST_COVER,
) -> DataFrame:
    """Licenses found in whole texts, by rows: ``id``, ``row_hash`` (of the text), ``license``, ``cosine``, ``share``.

    Passages are lines, and paragraphs of more than one line. A passage counts if its cosine to a template reaches ``least``, or reaches ``covered`` while it
    has ``cover`` of the template's weight. An SPDX tag with a known name counts with a cosine of 1. The license of a text is that of its best passage (ties:
    the first by name); ``share`` is the weight of the words in all its passages that count, each word once, over that of all its words. Null and
    empty texts have none; rows that repeat key and text are found once; null keys stay.
    """
    space = _Space(docs, text, list(templates))
    starts = rf"{space.starts(least)}|spdx-license-identifier"
    content = F.col(text)
    rows = docs.where(F.lower(content).rlike(starts)).select(F.col(key).alias("id"), F.xxhash64(content).alias("row_hash"), content.alias("body"))
    known = F.create_map(*[x for n in SPDX_NAMES for x in (F.lit(n.lower()), F.lit(n))])
    counts = lambda x: (x["cosine"] >= least) | ((x["cosine"] >= covered) & (x["cover"] >= cover))
    total = lambda words: F.aggregate(words, F.lit(0.0), lambda a, t: a + space.weight(t))

    def cut(body: Column) -> Column:
        wrapped = F.filter(F.split(body, _BLANK_LINES), lambda p: F.trim(p, F.lit("\r\n")).rlike(r"\r|\n"))
        return F.filter(F.concat(F.split(body, r"\r\n|\r|\n"), wrapped), lambda p: F.lower(p).rlike(starts))

    def tag(passage: Column) -> Column:
        # a tag stands for its line, not for the paragraph around it
        here = F.lower(passage).contains("spdx-license-identifier") & ~passage.rlike(r"\r|\n")
        return F.when(here, F.element_at(known, F.lower(F.regexp_extract(passage, SPDX_TAG, 1))))

    def hits_of(passage: Column) -> Column:
        hit = lambda cosine, license, words: F.when(license.isNotNull(), F.struct(cosine.alias("cosine"), license.alias("license"), words.alias("words")))

        def both(words: Column) -> Column:
            best = F.when(_may_reach(words, space, least), _best(F.filter(_scores(words, space), counts)))
            return F.array(_let(best, lambda b: hit(b["cosine"], b["license"], words)), _let(tag(passage), lambda name: hit(F.lit(1.0), name, words)))

        return _let(terms(passage), both)

    def judged(hits: Column, body: Column) -> Column:
        best = F.array_min(F.transform(hits, lambda h: F.struct((-h["cosine"]).alias("order"), h["license"].alias("license"), h["cosine"].alias("cosine"))))
        met = F.array_distinct(F.flatten(F.transform(hits, lambda h: h["words"])))
        # a license passage has more of its words elsewhere in the text only by accident: every word counts as often as it stands there
        inside = lambda words: _let(met, lambda m: F.filter(words, lambda t: F.array_contains(m, t)))
        share = _let(terms(body), lambda words: total(inside(words)) / total(words))
        return F.when(F.size(hits) > 0, _let(best, lambda b: F.struct(b["license"].alias("license"), b["cosine"].alias("cosine"), share.alias("share"))))

    hits = F.array_compact(F.flatten(F.transform(cut(F.col("body")), hits_of)))
    # written, so that no condition on the result is worked out by scoring again
    found = materialize(rows.select("id", "row_hash", _let(hits, lambda h: judged(h, F.col("body"))).alias("found")), "license-hits")
    return found.where("found is not null").select("id", "row_hash", "found.license", "found.cosine", "found.share").dropDuplicates(["id", "row_hash"])


def ancestors(path: Column) -> Column:
    """The directories above a path, the root (empty) first. Slashes at either end do not count."""
    parts = F.split(F.regexp_replace(path, "^/+|/+$", ""), "/+")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: F.concat_ws("/", F.slice(parts, 1, k)))


def inherit(files: DataFrame, path: str = "path", license: str = "license") -> DataFrame:
    """Add ``effective`` and ``inherited_from`` to ``files`` (path, license or null).

    A file with a license of its own keeps it. Others take that of the nearest directory above that has a license file with a
    license; of several in one directory the first by name. Null paths have only their own license.
    """
    directory = F.element_at(ancestors(F.col(path)), -1)
    speaking = (
        files.where(F.col(license).isNotNull() & F.col(path).rlike(LICENSE_FILE))
        .groupBy(directory.alias("of_directory"))
        .agg(F.min(license).alias("of_license"))
    )
    # one row per directory, not per file, climbs the tree
    directories = files.where(F.col(license).isNull() & F.col(path).isNotNull()).select(directory.alias("directory")).distinct()
    above = directories.select("directory", F.posexplode(F.array_append(ancestors(F.col("directory")), F.col("directory"))).alias("depth", "ancestor"))
    nearest = (
        above.join(speaking, F.col("ancestor") == F.col("of_directory"))
        .groupBy("directory")
        .agg(F.max(F.struct("depth", "ancestor", "of_license")).alias("best"))
        .select(F.col("directory").alias("at_directory"), F.col("best.ancestor").alias("from_directory"), "best.of_license")
    )
    met = files.withColumn("own_directory", directory).join(nearest, F.col("own_directory") == F.col("at_directory"), "left")
    own = F.col(license).isNotNull()
    return met.select(
        *files.columns,
        F.coalesce(license, "of_license").alias("effective"),
        F.when(~own, F.col("from_directory")).alias("inherited_from"),
    )


def scan_files(
    docs: DataFrame, path: Column, key: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = LICENSE_TEXTS, least: float = LEAST_COSINE, file_share: float | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``path``, ``license``, ``cosine``, ``share``, ``effective``, ``inherited_from``.

    A file's own license is that of its best passage (see `scan_passages`). Where paths do not say which files are licenses, ``file_share`` does: a file with
    that much of its weight in license passages speaks for its directory, under the name ``LICENSE.`` and its own. An empty table gives an empty result.
    """
    found = scan_passages(docs, key, text, templates, least).select(F.col("id").alias("of_id"), F.col("row_hash").alias("of_hash"), "license", "cosine", "share")
    files = docs.select(F.col(key).alias("id"), path.alias("path"), F.xxhash64(F.col(text)).alias("row_hash"))
    own = files.join(found, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("row_hash") == F.col("of_hash")), "left").select("id", "path", "license", "cosine", "share")
    if file_share is not None:
        speaks = F.regexp_replace("path", r"^((?:.*/)?)([^/]*)$", "$1LICENSE.$2")
        own = own.withColumn("path", F.when(F.col("share") >= file_share, speaks).otherwise(F.col("path")))
    # inheritance reads the files three times
    return inherit(materialize(own, "license-files"))
