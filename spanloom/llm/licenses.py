"""License scan by ordered signature rules, in DataFrame operations only.

A rule is a regular expression over words; rules() builds some hundreds of them from families of licenses and the forms in
which texts name them. Only text around an anchor (a word that every rule has, such as "license") is looked at: a text
becomes windows of a rule's length on both sides of its anchors, which is exact and mostly empty. Words of a window find the
rules that need them by a join (the keyword prefilter), and only those are run as expressions. Of detections that
overlap, those of a better priority stay, and of one priority those that no other one contains.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm._common import documents, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words of which each rule has one that can't be absent.
ANCHORS = r"licen[cs]e[ds]?|spdx|hereby|redistribut(?:e|ed|ion)|warrant(?:y|ies)|copyright|reserved|domain|gplv[23]|unlicense|wtfpl|cc0"

#: Phrases whose places count as base places, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# --- the rules: words are separated by spaces, [word] may be absent, LICENSE is a license in any spelling ---

#: label, its short name, its full names.
NAMED = (
    ("mit", "mit", "mit LICENSE", "expat LICENSE"),
    ("mit-0", "mit 0", "mit no attribution LICENSE"),
    ("x11", "x11", "x11 LICENSE"),
    ("isc", "isc", "isc LICENSE"),
    ("bsd", "bsd", "bsd [style] LICENSE"),
    ("bsd-2-clause", "bsd 2 clause", "bsd 2|two clauses? LICENSE", "2|two clause bsd LICENSE", "simplified bsd LICENSE", "freebsd LICENSE"),
    ("bsd-3-clause", "bsd 3 clause", "bsd 3|three clauses? LICENSE", "3|three clause bsd LICENSE", "new|modified|revised bsd LICENSE"),
    ("bsd-4-clause", "bsd 4 clause", "bsd 4|four clauses? LICENSE", "4|four clause bsd LICENSE", "original bsd LICENSE"),
    ("0bsd", "0bsd", "zero clause bsd LICENSE", "bsd zero clause LICENSE"),
    ("apache", "apache", "apache [software] LICENSE"),
    ("gpl", "gpl", "gnu [general] public LICENSE"),
    ("lgpl", "lgpl", "lesser|library general public LICENSE"),
    ("agpl", "agpl", "affero general public LICENSE"),
    ("zlib", "zlib", "zlib [libpng] LICENSE"),
    ("libpng", "libpng", "png reference library LICENSE", "libpng LICENSE"),
    ("openssl", "openssl", "openssl LICENSE"),
    ("postgresql", "postgresql", "postgresql LICENSE"),
    ("ncsa", "ncsa", "university of illinois [ncsa] [open] [source] LICENSE", "illinois ncsa open source LICENSE"),
    ("ruby", "ruby", "ruby LICENSE"),
    ("vim", "vim", "vim LICENSE"),
    ("curl", "curl", "curl LICENSE"),
    ("json", "json", "json LICENSE"),
    ("php", "php", "php LICENSE"),
    ("python", "psf", "python [software] [foundation] LICENSE", "psf LICENSE"),
    ("ijg", "ijg", "independent jpeg group LICENSE"),
    ("info-zip", "info zip", "info zip LICENSE"),
    ("bzip2", "bzip2", "bzip2 LICENSE"),
    ("icu", "icu", "icu LICENSE"),
    ("unicode", "unicode dfs", "unicode LICENSE"),
    ("imagemagick", "imagemagick", "imagemagick LICENSE"),
    ("sleepycat", "sleepycat", "sleepycat LICENSE"),
    ("w3c", "w3c", "w3c [software] LICENSE"),
    ("ms-pl", "ms pl", "microsoft public LICENSE"),
    ("ms-rl", "ms rl", "microsoft reciprocal LICENSE"),
    ("unlicense", "unlicense", "the unlicense"),
    ("wtfpl", "wtfpl", "do what the fuck you want to public LICENSE"),
    ("beerware", "beerware", "beer ware LICENSE", "beerware LICENSE"),
    ("commercial", "commercial", "commercial LICENSE", "enterprise LICENSE"),
    ("proprietary", "proprietary", "proprietary LICENSE", "end user LICENSE agreement"),
    ("free-software", "free", "free software LICENSE"),
    ("open-source", "open source", "open source LICENSE"),
)

#: label, short name, full name, versions.
VERSIONED = (
    ("gpl", "gpl", "gnu [general] public LICENSE", "1.0 2.0 3.0"),
    ("lgpl", "lgpl", "lesser|library general public LICENSE", "2.0 2.1 3.0"),
    ("agpl", "agpl", "affero general public LICENSE", "1.0 3.0"),
    ("gfdl", "gfdl", "free documentation LICENSE", "1.1 1.2 1.3"),
    ("apache", "apache", "apache [software] LICENSE", "1.0 1.1 2.0"),
    ("mpl", "mpl", "mozilla public LICENSE", "1.0 1.1 2.0"),
    ("epl", "epl", "eclipse public LICENSE", "1.0 2.0"),
    ("cpl", "cpl", "common public LICENSE", "1.0"),
    ("ipl", "ipl", "ibm public LICENSE", "1.0"),
    ("cddl", "cddl", "common development and distribution LICENSE", "1.0 1.1"),
    ("eupl", "eupl", "european union public LICENSE", "1.0 1.1 1.2"),
    ("osl", "osl", "open software LICENSE", "1.0 2.0 2.1 3.0"),
    ("afl", "afl", "academic free LICENSE", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic", "artistic LICENSE", "1.0 2.0"),
    ("bsl", "bsl", "boost software LICENSE", "1.0"),
    ("ofl", "ofl", "open font LICENSE", "1.0 1.1"),
    ("odbl", "odbl", "open database LICENSE", "1.0"),
    ("odc-by", "odc by", "open data commons attribution LICENSE", "1.0"),
    ("lppl", "lppl", "latex project public LICENSE", "1.0 1.1 1.2 1.3"),
    ("zpl", "zpl", "zope public LICENSE", "1.1 2.0 2.1"),
    ("upl", "upl", "universal permissive LICENSE", "1.0"),
    ("apsl", "apsl", "apple public source LICENSE", "1.0 1.1 1.2 2.0"),
    ("cecill", "cecill", "cecill [free] [software] LICENSE", "1.0 1.1 2.0 2.1"),
    ("qpl", "qpl", "q public LICENSE", "1.0"),
    ("rpl", "rpl", "reciprocal public LICENSE", "1.1 1.5"),
    ("sspl", "sspl", "server side public LICENSE", "1.0"),
    ("busl", "busl", "business source LICENSE", "1.0 1.1"),
    ("elastic", "elastic", "elastic LICENSE", "2.0"),
    ("nasa", "nasa", "nasa open source agreement LICENSE", "1.3"),
    ("php", "php", "php LICENSE", "3.0"),
)

#: Elements of the attribution licenses, and their versions; the full names follow from the elements.
SHARED, SHARED_VERSIONS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"), "1.0 2.0 2.5 3.0 4.0"
ELEMENTS = {"by": "attribution", "sa": "share[ ]alike", "nc": "non[ ]commercial", "nd": "no[ ]derivatives?|no[ ]derivs"}

#: Sentences of the texts themselves.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("historical-permission", "permission to use copy modify and distribute this software and its documentation for any purpose [with] [or] [without] [fee] is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "to endorse or promote products derived from this software without specific prior written permission [of] [the] copyright"),
    ("apache-2.0", "licensed under the apache LICENSE version 2 0 the LICENSE"),
    ("apache-2.0", "apache org LICENSE LICENSE 2 0"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public LICENSE"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser|library general public LICENSE"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public LICENSE"),
    ("or-later", "either version 1|2|3 of the LICENSE or at your option any later version"),
    ("gpl-2.0", "gplv2"),
    ("gpl-3.0", "gplv3"),
    ("mpl-2.0", "subject to the terms of the mozilla public LICENSE v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty"),
    ("as-is", "provided as is without warranty of any kind"),
    ("as-is", "without warranties or conditions of any kind"),
    ("as-is", "absolutely no warranty"),
    ("public-domain", "released|dedicated|placed in|into|to the public domain"),
    ("public-domain", "in the public domain"),
    ("public-domain", "public domain dedication"),
    ("cc0-1.0", "cc0"),
    ("copyright", "copyright [c] (?:19|20)[0-9][0-9]"),
    ("all-rights-reserved", "all rights reserved"),
    ("no-redistribution", "may not be redistributed|copied without [prior] [written] permission [of] [the] [copyright] copyright"),
)

#: Share of certainty and priority of a rule by its form: a tag or grant, a sentence, a full name, a short name after "license".
FORMS = {"tag": (1.0, 1), "grant": (0.95, 1), "sentence": (0.9, 1), "name": (0.8, 2), "base": (0.7, 3), "field": (0.6, 3)}

_LICENSE = "licen[cs]es?"


def expression(words: str) -> str:
    """The regular expression of a rule over text in which each word has a space of its own on either side."""
    out = []
    for word in words.replace("[ ]", "[_]").split():
        optional = word.startswith("[") and word.endswith("]") and word != "[_]"
        body = (word[1:-1] if optional else word).replace("LICENSE", _LICENSE).replace("[_]", "(?:  )?")
        body = f" (?:{body}) " if re.search(r"[^a-z0-9]", body) else f" {body} "
        out.append(f"(?:{body})?" if optional else body)
    return "".join(out)


def _needs(words: str) -> list[str]:
    """Words that a match surely has."""
    return list(dict.fromkeys(w for w in words.split() if re.fullmatch("[a-z0-9]+", w)))


def _length(words: str) -> int:
    return sum(w.count("[ ]") + 1 for w in words.replace("[ ]", "[_]").split()) + words.count("[ ]")


@cache
def rules() -> tuple[tuple[int, str, str, float, int, str, tuple[str, ...], str], ...]:
    """(rank, label, form, weight, priority, key, needs, words) of every rule, in order; key is the longest needed word."""
    found: list[tuple[str, str, str]] = []

    def forms(label: str, short: str, names: tuple[str, ...], version: str = "") -> None:
        major, _, minor = version.partition(".")
        short_v = f"{short} v?{major} {'[0]' if minor == '0' else minor}" if version else short
        name_v = f" [v|version] v?{major} {'[0]' if minor == '0' else minor}" if version else ""
        found.append((label, "tag", f"spdx LICENSE identifier {short_v}"))
        found.extend((label, "grant", f"licensed|released|distributed|available|covered|provided|published under [the|a|an] [terms] [of] [the] {n}{name_v}") for n in names)
        found.extend((label, "name", f"{n}{name_v}") for n in names)
        found.append((label, "field", f"LICENSE {short_v}"))

    for label, short, name, versions in VERSIONED:
        for version in versions.split():
            forms(f"{label}-{version}", short, (name,), version)
            if label in ("gpl", "lgpl", "agpl"):
                found.append((f"{label}-{version}-or-later", "tag", f"spdx LICENSE identifier {short} {version.replace('.', ' ')} or later"))
    for parts, version in product(SHARED, SHARED_VERSIONS.split()):
        name = "creative commons " + " ".join(ELEMENTS[p] for p in parts.split())
        number = version.replace(".0", " [0]").replace(".", " ")
        forms(f"cc-{parts.replace(' ', '-')}-{version}", f"cc {parts} {number}", (f"{name} {number} [international|unported|generic] LICENSE", f"{name} LICENSE {number}"))
    for label, short, *names in NAMED:
        forms(label, short, tuple(names))
    found += [(label, "sentence", words) for label, words in SENTENCES]
    found += [(label, "base", words) for words, label in BASE]
    return tuple((i, label, form, *FORMS[form], max(_needs(words), key=len), tuple(_needs(words)), words) for i, (label, form, words) in enumerate(found))


# --- texts as windows around anchors ---


def _n_words(text: Column) -> Column:
    """Words of text in which each has a space on either side."""
    return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))) / 2).cast("long")


def spaced(text: str = "text") -> Column:
    """The words of a text, A-Z as a-z, each with a space of its own on either side; empty for a text without a word."""
    words = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), BETWEEN, "  "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def windows(docs: DataFrame, reach: int) -> DataFrame:
    """(doc_id, sha, n_words, part, window, skipped, times): the windows of each text, in order, of texts without an anchor a
    single empty one; skipped is how many words are left out before. Equal rows come once, `times` says how often.

    The text from one anchor up to the next is a piece; of one of over 2 * reach words only the first and last `reach` stay.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).select("doc_id", F.unhex(F.sha2("_text", 256)).alias("sha"), spaced("_text").alias("_words"))

    def shortened(piece: Column) -> Column:
        n = _n_words(piece)
        head, tail = F.concat(F.substring_index(piece, "  ", reach), F.lit(" ")), F.concat(F.lit(" "), F.substring_index(piece, "  ", -reach))
        return F.when(n <= 2 * reach, piece).otherwise(F.concat(head, F.lit("\n"), (n - 2 * reach).cast("string"), F.lit("\n"), tail))

    pieces = F.split("_words", f"(?= (?:{ANCHORS}) )")
    text = F.when(F.col("_words").rlike(f" (?:{ANCHORS}) "), F.array_join(F.transform(pieces, shortened), "")).otherwise("")
    cut = rows.select("doc_id", "sha", _n_words(F.col("_words")).alias("n_words"), F.split(text, "\n").alias("_parts"))
    # the parts are window, words left out, window, words left out, ...
    numbers = F.sequence(F.lit(0), F.size("_parts") - 1, F.lit(2))
    at = lambda i: F.element_at("_parts", (i + 1).cast("int"))
    each = cut.select("doc_id", "sha", "n_words", F.explode(F.transform(numbers, lambda i: F.struct((i / 2).cast("int").alias("part"), at(i).alias("window"), F.when(i > 0, at(F.greatest(i - 1, F.lit(0))).cast("long")).otherwise(0).alias("skipped")))).alias("_w"))
    return each.groupBy("doc_id", "sha", "n_words", "_w.part", "_w.window", "_w.skipped").agg(F.count("*").alias("times"))


# --- detections ---


def detections(cut: DataFrame) -> DataFrame:
    """(doc_id, sha, label, form, weight, first, last, kept) of every place in the windows where a rule matches: its first word
    and the one behind its last, and whether it stays.

    It goes if one of better priority overlaps it, or one of the same priority contains it that is longer or, of the same
    words, earlier in order. All detections count in this, those that go too.
    """
    spark = cut.sparkSession
    table = [(rank, label, form, weight, priority, key, list(needs), expression(words)) for rank, label, form, weight, priority, key, needs, words in rules()]
    table = spark.createDataFrame(table, "rank int, label string, form string, weight double, priority int, key string, needs array<string>, pattern string")
    key = ["doc_id", "sha"]
    along = Window.partitionBy(*key).orderBy("part")
    before = F.coalesce(F.sum(_n_words(F.col("window"))).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.sum("skipped").over(along.rowsBetween(Window.unboundedPreceding, 0))
    placed = cut.withColumn("_start", before).where("window <> ''")
    words = placed.select(*key, "part", "_start", "window", F.explode(F.array_distinct(F.split(F.trim("window"), "  "))).alias("key"))
    # some hundreds of rules, whatever the data
    met = words.join(F.broadcast(table), "key").where(F.forall("needs", lambda w: F.contains(F.col("window"), F.concat(F.lit(" "), w, F.lit(" "))))).drop("needs", "key")
    hits = met.withColumn("_hits", F.regexp_extract_all("window", F.col("pattern"), F.lit(0))).where(F.size("_hits") > 0)
    gaps = F.slice(F.split("window", F.col("pattern")), F.lit(1), F.size("_hits"))
    each = hits.select(*key, "part", "_start", "rank", "label", "form", "weight", "priority", F.posexplode(F.arrays_zip(gaps.alias("gap"), F.col("_hits").alias("hit"))).alias("_i", "_m"))
    each = each.withColumns({"_gap": _n_words(F.col("_m.gap")), "_hit": _n_words(F.col("_m.hit"))}).drop("_m")
    upto = Window.partitionBy(*key, "part", "rank").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_start") + F.sum(F.col("_gap") + F.col("_hit")).over(upto)
    found = each.withColumn("last", last).withColumn("first", F.col("last") - F.col("_hit"))
    within = Window.partitionBy(*key, "priority").orderBy("first", F.desc("last"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    contained = F.coalesce(F.max("last").over(within) >= F.col("last"), F.lit(False))
    earlier = Window.partitionBy(*key).orderBy("first").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    later = Window.partitionBy(*key).orderBy("first").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    better = lambda p, c: F.when(F.col("priority") < p, F.col(c))
    over = lambda p: (F.max(better(p, "last")).over(earlier) > F.col("first")) | (F.min(better(p, "first")).over(later) < F.col("last"))
    overlapped = F.coalesce(F.when(F.col("priority") == 2, over(2)).when(F.col("priority") == 3, over(3)), F.lit(False))
    return found.withColumn("kept", ~contained & ~overlapped).select(*key, "label", "form", "weight", "first", "last", "kept")


def scan(docs: DataFrame) -> DataFrame:
    """Of every row doc_id, n_words, n_base, first_word, last_word (of base places), base_labels, labels (those of detections
    that stay and the base ones; sorted, joined by commas) and score, the certainty of the surest detection that stays.

    A null text counts as empty: no words, empty labels, a score of 0. Equal rows have equal results, one for each of them;
    a null doc_id is a doc_id. Other columns are ignored. detections() has the places.
    """
    cut = materialise(windows(docs, max(_length(words) for *_, words in rules())), "windows")
    base, key = F.col("form") == "base", ["doc_id", "sha"]
    found = detections(cut).groupBy(*key).agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"), F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"), F.collect_set(F.when(base | F.col("kept"), F.col("label"))).alias("labels"), F.max(F.when(F.col("kept"), F.col("weight"))).alias("score"),
    )
    found = found.select(F.col("doc_id").alias("_doc_id"), F.col("sha").alias("_sha"), *found.columns[2:])
    texts = cut.where("part = 0").select(*key, "n_words", "times")
    joined = texts.join(found, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("sha") == F.col("_sha")), "left")
    joined = joined.withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("times"))))
    names = lambda c: F.array_join(F.array_sort(F.coalesce(c, F.array().cast("array<string>"))), ",").alias(c)
    return joined.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", names("base_labels"), names("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


_SQL_WORDS = "((strlen({0}) - strlen(replace({0}, ' ', ''))) // 2)"

OP11_SQL = rf"""
WITH rules(rank, label, form, weight, priority, pattern) AS (VALUES {", ".join(f"({i}, '{label}', '{form}', {weight}::DOUBLE, {priority}, '{expression(words)}')" for i, label, form, weight, priority, _, _, words in rules())}),
t AS (SELECT row_number() OVER () AS id, doc_id, trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{BETWEEN}', '  ', 'g'), ' ') AS w FROM documents),
d AS (SELECT id, doc_id, CASE WHEN w = '' THEN '' ELSE ' ' || w || ' ' END AS w FROM t),
m AS (
  SELECT id, rank, label, form, weight, priority, regexp_extract_all(w, pattern) AS hits, string_split_regex(w, pattern) AS gaps
  FROM d, rules WHERE regexp_matches(w, ' ({ANCHORS}) ') AND regexp_matches(w, pattern)),
e AS (SELECT *, unnest(hits) AS hit, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM m),
p AS (
  SELECT *, last - {_SQL_WORDS.format("hit")} AS first FROM (
    SELECT *, sum({_SQL_WORDS.format("hit")} + {_SQL_WORDS.format("gap")}) OVER (PARTITION BY id, rank ORDER BY i ROWS UNBOUNDED PRECEDING) AS last FROM e)),
k AS (
  SELECT *, NOT EXISTS (SELECT 1 FROM p o WHERE o.id = p.id AND (o.priority < p.priority AND o.first < p.last AND p.first < o.last
    OR o.priority = p.priority AND o.first <= p.first AND o.last >= p.last AND (o.last - o.first > p.last - p.first OR o.rank < p.rank))) AS kept FROM p),
g AS (
  SELECT id, count(*) FILTER (form = 'base') AS n_base, min(first) FILTER (form = 'base') AS first_word, max(first) FILTER (form = 'base') AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (form = 'base') AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (form = 'base' OR kept) AS labels,
    max(weight) FILTER (kept) AS score FROM k GROUP BY id)
SELECT doc_id, {_SQL_WORDS.format("w")} AS n_words, coalesce(n_base, 0) AS n_base, cast(first_word AS BIGINT) AS first_word, cast(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN g ON d.id = g.id
"""
