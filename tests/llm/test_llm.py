import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

bpe = pytest.importorskip("spanloom.llm.bpe")
from spanloom.llm import language, mixing, nearcopies, neighbours, quality, sharding, simhash, spotsigs, suffix, tokencounts  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, score double, doc long, kept string, node long, runs string"
LONG = "the long text of a house and of many words. " * 400
CLASH = (7, "k", 7, "r")
ODD = [
    (0, "the cat sat on the mat and the dog", "en", "a", 1, 5, 0.5),
    (0, "the cat sat on the mat and the dog", "en", "a", 1, 5, 0.5),
    (1, None, None, None, None, None, None),
    (2, "", "en", "a", 0, 1, 1.0),
    (3, "  \n\t ", None, "b", 4, 1, 1.0),
    (None, "der Hund und die Katze sind im Haus", "de", None, 3, 1, 1.0),
    (5, LONG, "en", "b", len(LONG), 1, 1.0),
    (6, LONG, "en", "b", len(LONG), 1, 1.0),
    (7, "12345 !!", "xx", "c", 8, 1, 1.0),
    (8, "x" * 5000, None, "c", 5000, 1, 1.0),
    (9, "été 日本語 🎉 ß", "fr", "c", 9, 1, 1.0),
]
ODD = [(*row, *CLASH) for row in ODD]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def all_operators(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10)] + [(None, 1, None), (3, None, 1)], LABELS)
    return {
        1: sharding.shard(docs), 2: language.identify(docs), 3: quality.score_documents(docs, labels), 4: simhash.simhash_components(docs),
        6: mixing.mix(docs), 7: spotsigs.compare_edited(docs), 8: suffix.without_repeats(docs),
        9: bpe.encode_documents(docs, bpe.public_path("word_bpe_49k.json")),
        10: tokencounts.count_tokens(tokencounts.flatten(docs, bpe.public_path("byte_bpe_50k.tiktoken"))),
    }


def test_odd_rows_each_get_a_result(spark, odd):
    for n, result in all_operators(spark, odd).items():
        got = result.collect()
        assert len(got) == len(ODD), n
        if n != 10:
            assert sorted(r.doc_id if r.doc_id is not None else -1 for r in got) == sorted(r[0] if r[0] is not None else -1 for r in ODD), n


def test_long_ids_stay_exact_beside_nulls(spark):
    docs = spark.createDataFrame([((1 << 53) + 1, "a b"), (None, "c")], "doc_id long, text string").coalesce(1)
    path = bpe.public_path("word_bpe_49k.json")
    for found in (bpe.encode_documents(docs, path), spotsigs.compare_edited(docs), tokencounts.flatten(docs, bpe.public_path("byte_bpe_50k.tiktoken")).select(F.explode("ended").alias("doc_id"))):
        assert {r.doc_id for r in found.collect()} == {(1 << 53) + 1, None}


def test_empty_tables_give_empty_results(spark, empty):
    for n, result in all_operators(spark, empty).items():
        assert result.count() == 0, n


def test_pipeline_stages_keep_columns(spark, odd, empty):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], LABELS)
    for docs in (odd, empty):
        kept = quality.keep_good(docs, labels)
        once = nearcopies.drop_near_copies(kept)
        cut = suffix.drop_repeats(once)
        mixed = mixing.take_mix(cut)
        assert kept.columns == once.columns == cut.columns == mixed.columns == docs.columns
        assert once.count() <= kept.count() and cut.count() == once.count()
        mixed.collect()


def test_shards_have_the_loads_of_plain_scheduling(spark):
    rng = random.Random(1)
    texts = [rng.choice("abcdef") * rng.randint(0, 40) for _ in range(700)] + [None] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard(docs).toPandas()
    sizes: dict = {}
    for t in texts:
        sizes[t] = sizes.get(t, 0) + len(t or "") + 1
    loads = [0] * 16
    for s in sorted(sizes.values(), reverse=True):
        heapq.heapreplace(loads, loads[0] + s)
    assert sorted(loads) == sorted(got.groupby("shard")["size"].sum().reindex(range(16), fill_value=0))
    assert all(sorted(x) == list(range(len(x))) for _, x in got.groupby("shard").slot)
    by_text = got.assign(text=[texts[i] for i in got.doc_id]).groupby("text", dropna=False).shard.nunique()
    assert by_text.max() == 1
    assert all((zlib.crc32(texts[i].encode()) if texts[i] is not None else None) == (None if pd.isna(c) else int(c)) for i, c in zip(got.doc_id, got.text_crc32, strict=True))


def test_covering_masks_miss_no_pair_and_groups_split_exactly(spark, monkeypatch):
    masks = [m % (1 << 64) for m in simhash.cover(list(range(64)))]
    rng = random.Random(2)
    for _ in range(300):
        d = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not m & d for m in masks)
    monkeypatch.setattr(simhash, "BUCKET", 8)
    base = [rng.getrandbits(63) for _ in range(20)]
    fps = sorted({b ^ sum(1 << x for x in rng.sample(range(62), rng.randint(0, 4))) for b in base for _ in range(12)})
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.near_components(rows).collect()}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {f: find(i) for i, f in enumerate(fps)}


def fingerprint_by_hand(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "").encode())
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_are_those_by_hand(monkeypatch):
    rng = random.Random(3)
    texts = ["", None, " \n", "One", "One two", "ÄB äb\x0bx\x1cy ", "a " * 50, *(" ".join(rng.choices("ab cd É".split(), k=rng.randint(1, 30))) for _ in range(40))]
    for chunk in (1 << 16, 5):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert all(simhash.fingerprint_of(t) % (1 << 64) == fingerprint_by_hand(t) for t in texts)


def test_words_at_hand_keep_their_tokens_as_bytes_and_come_back_from_both_generations(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 20)
    e = bpe.TreeEncoder(bpe.public_path("word_bpe_49k.json"))
    rng = random.Random(17)
    for _ in range(40):
        text = " ".join(rng.choice(["", "don't", "été", "日本語", "(x1)", "w" * 250, *(f"word{i}" for i in range(60))]) for _ in range(30))
        assert e._ids(text.split(" ")) == e.tokenizer.encode(text, add_special_tokens=False).ids
    assert e.old and all(isinstance(x, bytes) for x in [*e.new.values(), *e.old.values()]) and "w" * 250 not in e.new | e.old


def test_near_copies_without_an_id_are_kept_apart(spark):
    texts = ["one text of a house by the sea", "quite another one about trains and snow", "the third speaks of bread"]
    rows = [(None, x) for x in texts[:2]] + [(None, texts[2]), (7, texts[2]), (4, texts[2])]
    got = nearcopies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.text, r.doc_id) for r in got) == sorted([(texts[0], None), (texts[1], None), (texts[2], 4)])


def edited(rng, words, share):
    return [rng.choice("abcdefgh") * 3 if rng.random() < share else w for w in words]


@pytest.mark.parametrize("group", [1024, 8])
def test_near_copies_of_five_words_and_four_fifths_are_those_of_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(nearcopies, "GROUP", group)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    bases = [[rng.choice(vocabulary) for _ in range(150)] for _ in range(6)]
    texts = [" ".join(edited(rng, rng.choice(bases), rng.choice([0, 0.01, 0.02, 0.03, 0.06]))) for _ in range(160)]
    texts += ["", None, " ", "a b", "A  b", "a b c"]
    sets = [nearcopies.shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j])):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in nearcopies.drop_near_copies(docs).collect()} == set(root)


def test_near_copies_within_three_bits_meet_by_covering_masks_alone(spark, monkeypatch):
    rng = random.Random(21)
    texts = []
    for _ in range(12):
        base = [rng.choice("abcdefgh") + str(rng.randint(0, 999)) for _ in range(400)]
        texts += [" ".join(base), " ".join([*base, "one", "more"]), " ".join(base[:-1])]
    sets = [nearcopies.shingles(t) for t in texts]
    bits = [simhash.fingerprint_of_hashes(x) % (1 << 64) for x in sets]
    linked = []
    for i in range(0, len(texts), 3):
        near = [(i + j, i + k) for j in range(3) for k in range(j) if (bits[i + j] ^ bits[i + k]).bit_count() <= 3]
        linked += near
        assert all(set(nearcopies.masked_keys(sets[a])) & set(nearcopies.masked_keys(sets[b])) for a, b in near)
    assert len(linked) > 20
    monkeypatch.setattr(nearcopies, "BANDS", 0)
    monkeypatch.setattr(nearcopies, "keys_of", lambda found: [])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"))
    keys = spark.createDataFrame([(t, nearcopies.node_of(x), nearcopies.masked_keys(x)) for t, x in enumerate(sets)], "doc_id long, node long, keys array<long>")
    root = {n: {n} for n in map(nearcopies.node_of, sets)}
    for r in nearcopies.near_links(docs, rows.join(keys, "doc_id")).collect():
        both = root[r.a] | root[r.b]
        root |= dict.fromkeys(both, both)
    assert all(nearcopies.node_of(sets[a]) in root[nearcopies.node_of(sets[b])] for a, b in linked)


def cut_by_force(texts):
    seen, out = set(), {}
    for d, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(b[i : i + 100])
        out[d] = (int(gone.sum()), bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


def test_texts_over_a_chunk_and_passages_of_many_documents(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 700)
    monkeypatch.setattr(suffix, "GROUP", 4)
    rng = random.Random(12)
    own = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared, long = own(260), own(3000)
    texts = [(i, own(rng.randint(0, 200)) + shared[rng.randint(0, 40) :] + own(50)) for i in range(60)] + [(60, long), (61, own(10) + long + own(10)), (62, long * 2)]
    want = cut_by_force(texts)
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix.without_repeats(spark.createDataFrame(texts, "doc_id long, text string"), 5).collect()}
    assert got == want


def test_a_worker_settles_its_entries_in_bounded_memory():
    import tracemalloc

    def parts():
        rng = np.random.default_rng(5)
        for doc in range(1600):
            key = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
            yield key, key ^ np.uint64(5), doc, suffix._packed(0, np.arange(1000, dtype=np.int64) * 26, np.full(1000, 26))

    tracemalloc.start()
    n = sum(len(block) for block in suffix._blocks(parts(), last=False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1_600_000 and peak < 120e6


def test_levels_merge_and_stay_few(spark):
    texts = spark.createDataFrame([(i, "".join(random.Random(i).choices("abc ", k=400))) for i in range(60)], "doc long, text string").withColumn("variant", F.lit(0).cast("long"))
    family, sizes = suffix.SuffixLevels(4), []
    for i in range(5):
        family.add(texts.where(f"doc >= {i * 12} AND doc < {i * 12 + 12}"))
        sizes.append(len(family.levels))
    assert max(sizes) <= 3 and len(family.tables) > 5
    plan = suffix.merge_scan(suffix.suffix_array(texts).repartition(4, "key"), [x for _, x in family.levels])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    family.drop()


@pytest.mark.parametrize("group", [256, 1])
def test_repeats_are_those_of_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(suffix, "GROUP", group)
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "délta", "of", "the"]
    passages = [" ".join(rng.choices(words, k=40)) for _ in range(4)]
    texts = []
    for d in range(40):
        parts = [rng.choice(passages)[rng.randint(0, 30) :] if rng.random() < 0.5 else " ".join(rng.choices(words, k=30)) for _ in range(4)]
        texts.append((d, " ".join(parts)))
    texts += [(40, "a" * 400), (41, "ab" * 300), (42, None), (43, "a" * 99), (44, "a" * 100)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = cut_by_force(texts)
    for batches in (1, 4):
        got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix.without_repeats(docs, batches).collect()}
        assert got == want


@pytest.mark.parametrize("parts", [1, 7])
def test_repeated_and_unnumbered_rows_lose_what_brute_force_says(spark, parts):
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "délta", "of", "the"]
    own = lambda n: " ".join(rng.choices(words, k=n))
    shared = own(40)
    rows = [(1, own(50)), (2, shared + own(20)), (None, own(60)), (None, shared), (5, own(30) + shared), (6, "short")]
    rows += [(None, own(30)) for _ in range(90)] + [(3, own(30)) for _ in range(5)] + [(3, shared), (None, None), (6, None)]
    docs = spark.createDataFrame(rows + rows[:12] + rows[-4:], "doc_id long, text string").repartition(parts)
    place = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(place, key=lambda x: (x[0] is not None, x[0] or 0, place[x]))
    want = cut_by_force([((d, t), t) for d, t in order])
    got = suffix.without_repeats(docs.withColumn("copy_of", F.col("text"))).collect()
    assert len(got) == len(rows) + 16
    assert all((r.n_removed, bytes(r.kept)) == want[r.doc_id, r.copy_of] for r in got)


def odd_text(rng, n):
    return "".join(rng.choice(rng.choice(["ab", "aé́b'sçß", "'!.s're1", "日本🎉", " \n\t"])) for _ in range(n))


def encodings_differ(e, texts):
    out = 0
    for x in texts:
        ids = e.tokenizer.encode(x, add_special_tokens=False).ids
        out += e.encode(x) != (len(ids), " ".join(map(str, ids)), e.tokenizer.decode(ids, skip_special_tokens=False))
    return out


@pytest.mark.parametrize(("part", "reach"), [(7, 1), (32, 4), (64, 64)])
def test_tree_concatenation_is_exact(part, reach):
    rng = random.Random(part)
    e = bpe.TreeEncoder(bpe.public_path("word_bpe_49k.json"), part, reach)
    assert e.by_word
    assert encodings_differ(e, [odd_text(rng, rng.randint(0, 300)) for _ in range(200)] + ["some plain words of a text " * 20, "x" * 500]) == 0
    assert e.windows > 500


def test_without_windows_the_halves_do_not_join(monkeypatch):
    rng = random.Random(2)
    texts = [odd_text(rng, 300) for _ in range(50)]
    monkeypatch.setattr(bpe.TreeEncoder, "join", lambda self, text, left, right, *_: left + right)
    assert encodings_differ(bpe.TreeEncoder(bpe.public_path("word_bpe_49k.json"), 32), texts) > 40


def test_a_tokenizer_that_does_not_part_at_spaces_has_trees_too(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(bpe.TreeEncoder, "_parts_at_spaces", lambda self: False)
    e = bpe.TreeEncoder(bpe.public_path("word_bpe_49k.json"), 40, 5)
    assert encodings_differ(e, [odd_text(rng, 400) for _ in range(40)]) == 0


def test_dealt_out_long_text_is_exact(spark, monkeypatch):
    monkeypatch.setattr(bpe, "SPREAD", 300)
    path = bpe.public_path("word_bpe_49k.json")
    texts = [(1, "abcdé" * 400), (2, "some words " * 100), (None, "x1!" * 300)]
    got = bpe.encode_documents(spark.createDataFrame(texts, "doc_id long, text string"), path, texts=True).collect()
    t = bpe.encoder(path).tokenizer
    assert {r.doc_id: r.ids for r in got} == {d: " ".join(map(str, t.encode(x, add_special_tokens=False).ids)) for d, x in texts}


def test_text_without_a_space_is_encoded_exactly():
    e = bpe.TreeEncoder(bpe.public_path("word_bpe_49k.json"))
    rng = random.Random(9)
    assert encodings_differ(e, ["".join(rng.choices(alphabet, k=60_000)) for alphabet in ("abcdefghijklmnop", "aé́1'sß", "日本語漢字")]) == 0
    assert e.windows >= 45


def test_whole_texts_are_halved_anywhere_and_joined_exactly():
    rng = random.Random(10)
    for part in (1, 5, 64):
        e = bpe.TreeEncoder(bpe.public_path("word_bpe_49k.json"), part, 2)
        for _ in range(60):
            x = "".join(rng.choices(["ab", " ", "  ", "\n", "d'été", "x1!", "日本"], k=rng.randint(0, 60)))
            ids = e.tokenizer.encode(x, add_special_tokens=False).ids
            assert e.encode(x) == (len(ids), " ".join(map(str, ids)), e.tokenizer.decode(ids, skip_special_tokens=False))


def test_mix_comes_near_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 13), f"s{i % 7}" if i % 5 else None) for i in range(900)], "doc_id long, text string, source string")
    got = mixing.mix(docs).toPandas()
    assert (got.taken <= 2 * got["size"]).all() and (got.taken % got["size"].replace(0, 1) == 0).all()
    for _, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 2 * g["size"].max()


def test_gram_counts_are_those_by_hand(monkeypatch):
    def by_hand(text):
        codes = [language.EDGE]
        for c in text.lower():
            code = ord(c) if c.isalpha() else language.EDGE
            if code != language.EDGE or codes[-1] != language.EDGE:
                codes.append(code)
        codes += [language.EDGE] if codes[-1] != language.EDGE else []
        out = Counter(c for c in codes if c != language.EDGE)
        out.update(a << 21 | b for a, b in zip(codes, codes[1:], strict=False))
        out.update(a << 42 | b << 21 | c for a, b, c in zip(codes, codes[1:], codes[2:], strict=False) if b != language.EDGE)
        return out

    rng = random.Random(1)
    for chunk in (1, 2, 5, 1 << 20):
        monkeypatch.setattr(language, "CHUNK", chunk)
        for _ in range(100):
            text = "".join(rng.choices("abé 1\n", k=rng.randint(0, 14)))
            grams, counts = language.gram_counts(text)
            assert dict(zip(grams.tolist(), counts.tolist(), strict=True)) == by_hand(text)


def test_out_of_place_distance_is_that_by_hand():
    ranked = {"x": [97, 98, 99], "y": [98, 97, 120]}
    p = language.Profiles(ranked, 4)
    grams, counts = language.gram_counts("ab b")
    own = language.profile(grams, counts, 4).tolist()
    far = {k: sum(abs(v.index(g) - i) if g in v else 4 for i, g in enumerate(own)) for k, v in ranked.items()}
    best = min(sorted(far), key=far.get)
    assert p.predict("ab b") == (best, 1 - far[best] / (4 * len(own)))


def test_lines_by_chunk_have_the_features_of_the_whole(monkeypatch):
    rng = random.Random(7)
    texts = [None, "", "\n", "\n\n\n", "one line", "a\nb", "a\n", "\na", "same line\nother\nsame line\n" * 20, "\n".join("".join(rng.choices("abc ,.!1é", k=rng.randint(0, 30))) for _ in range(300))]
    want = [quality.line_features(t) for t in texts]
    field = quality.LineField(np.linspace(-1, 1, want[0][0].shape[1]), np.array([[0.3, -0.2], [0.1, 0.4]]))
    raw = [field.raw(t) for t in texts]
    for size in (1, 7, 50):
        monkeypatch.setattr(quality, "CHUNK", size)
        for t, (x, w), r in zip(texts, want, raw, strict=True):
            got = quality.line_features(t)
            assert np.array_equal(got[0], x) and np.array_equal(got[1], w) and abs(field.raw(t) - r) < 1e-12


def test_a_text_of_line_ends_takes_little_memory():
    import tracemalloc

    field = quality.LineField(np.full(quality.line_features("")[0].shape[1], 0.1), np.zeros((2, 2)))
    tracemalloc.start()
    score = field.raw("\n" * 1_000_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < score < 1 and peak < 150e6


def test_a_query_keeps_its_own_node_in_its_beam():
    far = pd.DataFrame({"q": [1], "own": [b""], "beam": [[{"id": 1, "near": float("inf")}]], "seen": [[1]], "ids": [[list(range(2, 400)), [1]]], "nears": [[[1.0] * 398, [0.5]]]})
    after = next(neighbours._merged(iter([far])))
    assert after["beam"][0][0] == {"id": 1, "near": float("inf")} and len(after["beam"][0]) == neighbours.BEAM


def test_rows_equal_to_a_query_are_found_in_a_dense_table(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(900, 8))
    base[::3] *= 0.2  # short vectors have many neighbours of a larger product
    rows = [(i, [float(np.float32(x)) for x in base[i % 900]]) for i in range(1000)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    v = np.array([r[1] for r in rows])
    found = want = 0
    for q in range(0, 1000, 20):
        product = v @ v[q]
        best = [int(i) for i in sorted(range(1000), key=lambda i: (-product[i], i)) if i != q][:20]
        mine = {r.vec_id for r in got if r.query_id == q}
        found, want = found + len(mine & set(best)), want + 20
    assert found >= 0.95 * want


def test_more_texts_of_one_doc_id_than_variants(spark, monkeypatch):
    monkeypatch.setattr(suffix, "VARIANTS", 8)
    rng = random.Random(16)
    own = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = own(200)
    rows = [(3, own(60) + shared[rng.randint(0, 60) :]) for _ in range(40)] + [(2, own(150)), (None, shared + own(20)), (4, shared), (4, shared), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    place = {(r.doc_id, r.text): r.h for r in docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(place, key=lambda x: (x[0] is not None, x[0] or 0, place[x]))
    want = cut_by_force([((d, t), t) for d, t in order])
    got = suffix.without_repeats(docs.withColumn("copy_of", F.col("text"))).collect()
    assert len(got) == len(rows) and all((r.n_removed, bytes(r.kept)) == want[r.doc_id, r.copy_of] for r in got)


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(5)
    for n in range(1, 7):
        field = quality.LineField(rng.normal(size=3), rng.normal(size=(2, 2)))
        x = rng.normal(size=(n, 3))
        e, weight = x @ field.weights, {}
        for labels in itertools.product((0, 1), repeat=n):
            weight[labels] = np.exp(sum(e[i] for i in range(n) if labels[i]) + sum(field.transitions[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        want = [sum(w for labels, w in weight.items() if labels[i]) / sum(weight.values()) for i in range(n)]
        assert np.allclose(field.marginals(field.evidence(x)), want)


def test_language_and_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    found = language.op2(spark, sf).toPandas().merge(docs, on="doc_id")
    assert (found[found.held_out].lang_pred == found[found.held_out].lang).mean() > 0.95
    scored = quality.op3(spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert (scored[scored.held_out].predicted == scored[scored.held_out].quality).mean() > 0.95


def test_edited_texts_and_next_ones(spark):
    texts = [(3, "the red house and the blue tree of the old town"), (1, "a b c d e f g h"), (2, None)]
    got = {r.doc_id: r for r in spotsigs.compare_edited(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    order = sorted(texts)
    for i, (d, t) in enumerate(order):
        own, after = t or "", order[(i + 1) % 3][1] or ""
        edited = own[: len(own) - len(own) // 4] + after[: len(own) // 4]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and 0 <= got[d].near_next <= 1


def test_near_pairs_are_those_of_all_pairs(spark):
    rng = random.Random(7)
    words = "the a of and to house tree river stone road bread light wind rain".split()
    bases = [[rng.choice(words) for _ in range(60)] for _ in range(5)]
    texts = ["", None, "the"] + [" ".join(rng.choice(words) if rng.random() < share else w for w in rng.choice(bases)) for share in (0, 0.01, 0.03, 0.1) for _ in range(15)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {spotsigs.digest(s): s for s in map(spotsigs.spots, texts) if len(s)}
    for least in (0.8, 0.5):
        want = {}
        for a, b in itertools.combinations(sets, 2):
            near = len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b]))
            if near >= least:
                want[frozenset((a, b))] = round(near, 9)
        got = {frozenset((r.a, r.b)): round(r.likeness, 9) for r in spotsigs.near_pairs(docs, least).collect()}
        assert got == want and want


def test_likeness_is_that_of_the_returned_sets(spark):
    texts = [(i, f"the house {i} and the tree of the old town by the sea {i % 2}") for i in range(6)]
    for r in spotsigs.compare_edited(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        a, b = set(r.signatures), set(r.edited_signatures)
        assert r.near_edited == len(a & b) / len(a | b)


def test_flat_files_are_read_and_counted(spark, tmp_path):
    rng = random.Random(2)
    want = {}
    for f in range(3):
        counts = [rng.randint(0, 40) for _ in range(30)]
        ids = [x for n in counts for x in [*(rng.randint(0, 50_000) for _ in range(n)), tokencounts.SEPARATOR]]
        (tmp_path / f"{f}.bin").write_bytes(np.array([*ids, 1, 2][: len(ids) + f], dtype="<u2").tobytes())
        want[f"{f}.bin"] = counts + ([f] if f else [])
    blocks = tokencounts.read_flat(spark, str(tmp_path), block=16)
    got = {}
    for r in sorted(tokencounts.count_tokens(blocks).collect(), key=lambda r: (r.file, r.block, r.k if r.k is not None else 1 << 30)):
        got.setdefault(r.file.rsplit("/", 1)[1], []).append(r.n_tokens)
    assert got == want


def test_token_counts_go_to_their_documents(spark):
    texts = [(i * 3, "word " * (i * 7 % 50)) for i in range(40)] + [(None, "x" * 30_000), (1, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    path = bpe.public_path("byte_bpe_50k.tiktoken")
    blocks = tokencounts.materialise(tokencounts.flatten(docs, path, block=64), "flat")
    log = blocks.select("file", "block", F.posexplode("ended").alias("k", "doc_id"))
    got = {r.doc_id: r.n_tokens for r in tokencounts.count_tokens(blocks).join(log, ["file", "block", "k"]).collect()}
    assert got == {d: len(tokencounts._tiktoken(path).encode_ordinary(t or "")) for d, t in texts}


def test_token_counts_over_small_blocks(spark):
    texts = [(i, "word " * (i * 7 % 50)) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    path = bpe.public_path("byte_bpe_50k.tiktoken")
    blocks = tokencounts.flatten(docs, path, block=64)
    counts = sorted(r.n_tokens for r in tokencounts.count_tokens(blocks).collect())
    assert counts == sorted(len(tokencounts._tiktoken(path).encode_ordinary(t)) for _, t in texts)


def test_neighbours_of_few_and_odd_vectors(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)] + [(60, None), (80, [0.0, 0.0, 0.0]), (100, [float("nan"), 1.0, 1.0]), (120, [1.0]), (121, [2.0]), (None, [1.0, 2.0, 3.0]), (140, [])]
    docs = spark.createDataFrame([(*r, 1) for r in rows + rows[:3]], "vec_id long, embedding array<float>, node long")
    got = neighbours.nearest(docs).toPandas()
    v = np.array([r[1] for r in rows[:60]])
    for q in (0, 20, 40):
        s = v @ v[q]
        want = sorted((i for i in range(60) if i != q), key=lambda i: (-s[i], i))[:20]
        assert got[got.query_id == q].sort_values("rank").vec_id.tolist() == want
    assert set(got.query_id) == {0, 20, 40, 120} and got[got.query_id == 120].vec_id.tolist() == [121]
    assert neighbours.nearest(docs.where("false")).count() == 0


def test_neighbour_recall(spark):
    v = np.random.default_rng(0).normal(size=(1500, 16)).astype(np.float32)
    got = neighbours.nearest(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")).toPandas()
    hits = []
    for q, g in got.groupby("query_id"):
        s = v.astype(float) @ v[q].astype(float)
        s[q] = -1e9
        hits.append(len(set(np.argsort(-s)[:20]) & set(g.vec_id)) / 20)
    assert np.mean(hits) > 0.9


def test_pipeline_runs_and_each_stage_takes_effect(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    source.withColumn("more", F.lit(1)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    docs, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.materialise(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        counts.append(docs.count())
    out = pipeline.run(spark, str(tmp_path))
    assert source.count() > counts[0] > counts[1] == counts[2] and out.count() == counts[3]
    assert set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
