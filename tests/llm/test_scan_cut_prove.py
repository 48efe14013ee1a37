"""License scan, fill-in-middle and manifest against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

licenses = pytest.importorskip("spanloom.llm.licenses")
from spanloom.llm import fim, merkle  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, output string, label string, place long, proof string, window string"
CLASH = (3, "o", "l", 4, "p", "w")


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), *CLASH) for i, t in texts], SCHEMA)


# --- licenses ---


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))
    spaced = "".join(f" {w} " for w in words)
    found = []
    for rank, label, form, weight, priority, _, _, pattern in licenses.rules():
        for m in re.finditer(licenses.expression(pattern), spaced):
            found.append((rank, label, form, weight, priority, spaced[: m.start()].count(" ") // 2, spaced[: m.end()].count(" ") // 2))

    def gone(d):
        for o in found:
            if o[4] < d[4] and o[5] < d[6] and d[5] < o[6] or o[4] == d[4] and o[5] <= d[5] and o[6] >= d[6] and (o[6] - o[5] > d[6] - d[5] or o[0] < d[0]):
                return True
        return False

    kept = [d for d in found if not gone(d)]
    base = [i for phrase, _ in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    base_labels = {label for phrase, label in licenses.BASE if f" {phrase.replace(' ', '  ')} " in spaced}
    assert sorted(base) == sorted(d[5] for d in found if d[2] == "base")
    return (len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {d[1] for d in kept})), max((d[3] for d in kept), default=0.0))


FILLER = "the cat sat on the mat and read about mit and public things under the terms of the house "
LICENSED = [
    "Licensed under the MIT License.", "SPDX-License-Identifier: GPL-3.0-or-later", "GNU General Public License, version 2", "the Apache License, Version 2.0 (the License)", "mit license license mit license",
    "Creative Commons Attribution-ShareAlike 4.0 International License", "Permission is hereby granted, free of charge, to any person obtaining a copy", "Mozilla Public License v. 2.0", "Copyright (c) 2020. All rights reserved.",
    "general public license general public licence", "unter der MIT Lizenz", "released under the terms of the GNU Lesser General Public License version 2.1", "MİT LICENSE", "license: apache-2.0", "été mit license été",
]


def test_scan_equals_plain_python(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "no words of that kind", *LICENSED, "".join(s + " " for s in LICENSED), "mit license " * 300, FILLER * 200 + LICENSED[0] + FILLER * 200 + LICENSED[3] + " " + FILLER * 3 + LICENSED[2]]
    for _ in range(40):
        texts.append(" ".join(rng.choice(LICENSED) if rng.random() < 0.3 else FILLER * rng.randint(0, 3) for _ in range(rng.randint(1, 9))))
    for _ in range(40):
        pool = re.findall(r"\w+", " ".join(LICENSED))
        texts.append(" ".join(rng.choice(pool) for _ in range(rng.randint(1, 200))))
    ids = [*range(len(texts)), None, 4, 4]
    texts += [LICENSED[0], LICENSED[0], LICENSED[0]]
    texts[4] = LICENSED[0]
    got = Counter(tuple(r) for r in licenses.scan(rows_of(spark, zip(ids, texts, strict=True))).collect())
    assert got == Counter((i, *plain_scan(t)) for i, t in zip(ids, texts, strict=True))


def test_scan_of_an_empty_table(spark):
    assert licenses.scan(rows_of(spark, [])).collect() == []


def test_rules_have_an_anchor_and_a_keyword():
    assert len(licenses.rules()) > 300
    anchor = re.compile(f"(?:{licenses.ANCHORS})")
    for *_, key, needs, words in licenses.rules():
        sure = [w for w in words.split() if not w.startswith("[")]
        assert any(all(anchor.fullmatch(a) for a in w.replace("LICENSE", "license").split("|")) for w in sure), words
        assert key in needs and set(needs) <= set(sure)


# --- fill-in-middle ---


def plain_fim(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:i]), "".join(tokens[i:j]), "".join(tokens[j:])
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_plain_python_and_restores(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "\n \t", "word", " word ", "a <P> b", "x<S", "é 日本 🎉 ß  \x0b end\n", "word " * 30_000, "x" * 50_000, "<S<P<M <" * 9]
    texts += ["".join(rng.choice("ab é🎉 \n\t<>PSM") for _ in range(rng.randint(1, 300))) for _ in range(150)]
    texts += ["copies of one text"] * 60
    ids = [*range(len(texts)), None, 5, 5]
    texts += ["null id", " word ", " word "]
    out = fim.fill_in_middle(rows_of(spark, zip(ids, texts, strict=True))).withColumn("again", fim.restored())
    assert set(out.columns) == {*SCHEMA.replace(" long", "").replace(" string", "").split(", "), "form", "prefix_chars", "middle_chars", "again"}
    got = out.collect()
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got) == Counter((i, *plain_fim(i, t)) for i, t in zip(ids, texts, strict=True))
    assert all(r.again == (r.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_an_empty_table(spark):
    assert fim.fill_in_middle(rows_of(spark, [])).collect() == []


def test_index_has_each_distinct_text_once():
    index = fim.TextIndex()
    for digest, text in [(b"a", "one text"), (b"a", "one text"), (b"a", "other"), (b"a", "one text"), (b"b", "one"), (b"b", "one")]:
        packed = index.of(digest, text)  # of texts with one digest, each keeps its own list
        assert fim.select(packed, fim.size_of(packed)) == len(text)
    assert index.made == 3
    assert set(index.lists) == {"one"}


@pytest.mark.parametrize("seed", range(30))
def test_lists_select_what_was_put_in(seed):
    rng = np.random.default_rng(seed)
    values = np.cumsum(rng.integers(1, rng.integers(2, 400), rng.integers(1, 500)))
    packed = fim.elias_fano(values)
    assert fim.size_of(packed) == len(values)
    assert [fim.select(packed, i) for i in range(len(values) + 1)] == [0, *values.tolist()]
    assert fim.elias_fano(np.array([], dtype=np.int64)) == fim.elias_fano(fim.token_ends(""))
    with pytest.raises(IndexError):
        fim.select(packed, len(values) + 1)


# --- manifest ---


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """Root, and of each node its siblings by level with its place."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = nodes[p // 3 * 3 : p // 3 * 3 + 3]
            proofs[i].append((p % 3, run[: p % 3] + run[p % 3 + 1 :]))
        at, nodes = [p // 3 for p in at], [sha(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], proofs


def plain_manifest(rows):
    def leaf(r, text):
        return sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[0], r[3], r[2], r[4], text)])

    def tampered(r):
        return r[1] if r[1] is None or r[0] is None or zlib.crc32(str(r[0]).encode()) % 2 else r[1].replace("\n", "")

    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(((r[0] is not None, r[0] or 0, leaf(r, r[1]), leaf(r, tampered(r))) for r in rows if r[3] == s)) for s in sources}
    built = {s: plain_tree([x[2] for x in trees[s]]) for s in sources}
    root, upper = plain_tree([built[s][0] for s in sources])
    for s, above in zip(sources, upper, strict=True):
        for (known, i, x, changed), own in zip(trees[s], built[s][1], strict=True):
            steps, at = own + above, changed
            for place, others in steps:
                at = sha(*others[:place], at, *others[place:])
            yield (i if known else None, x, built[s][0], root, sha(*[o for _, others in steps for o in others]), at, at == root)


def op13_rows(docs):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    out = merkle.manifest(docs, F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", F.col("folded_root") == F.col("root"))


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (4, 3, 9, 10, 27, 28), (243, 244), (800, 5, 1)])
def test_manifest_equals_plain_python(spark, sizes):
    rows = [(len(sizes) * i + k, f"text\n{i}", None if i % 5 else "en", None if k == 1 else f"é{k}", i, *CLASH) for k, n in enumerate(sizes) for i in range(n)]
    rows += [(None, None, None, None, None, *CLASH), (0, "text\n0", "en", "é0", 0, *CLASH), (0, "text\n0", "en", "é0", 0, *CLASH)] if len(sizes) > 2 else []
    got = Counter(tuple(r) for r in op13_rows(spark.createDataFrame(rows, SCHEMA)).collect())
    want = Counter(plain_manifest(rows))
    assert got == want
    assert sum(sizes) < 5 or any(not r[-1] for r in want)


def test_manifest_of_an_empty_table(spark):
    assert op13_rows(rows_of(spark, [])).collect() == []


def test_a_proof_folds_to_the_root_and_nothing_else_does(spark):
    rows = merkle.manifest(rows_of(spark, [(i, f"t{i}") for i in range(40)])).collect()
    for r in rows:
        assert merkle.fold(r.leaf, r.proof) == r.root == r.folded_root
        assert merkle.fold(merkle.digest([r.leaf]), r.proof) != r.root
