"""Small cases with defined results, and brute force, for the corpus operators."""

import collections
import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet  # noqa: F401
import pytest
import xxhash
from pyspark.sql import functions as F

from docframe.llm import _words as words
from docframe.llm import exact_dedup, fingerprint, lm_score, minhash, mixing, packing, quality, toxicity, warc
from docframe.llm._labels import labelled_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor " * 4000


def frame(spark, texts, source="s"):
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def mixed(spark):
    """Null and empty texts, repeated rows, ties, a very long text, and columns whose names the operators use."""
    docs = frame(spark, [(5, "a b c"), (3, "a b c"), (7, None), (8, ""), (9, LONG), (9, LONG), (None, "only null id"), (11, "ß é\n\n x")])
    return docs.withColumn("digest", F.lit("mine")).withColumn("_salt", F.lit(1)).withColumn("label", F.lit(2)).withColumn("spans", F.lit(3))


# ---- words ---------------------------------------------------------------------------------------------------


def test_words_against_split():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \t\n\x0b\x0c\r\x1cé ") for _ in range(rng.randrange(30))) for _ in range(500)] + [None, ""]
    hashes, rows = words.words(pa.array(texts))
    want = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(rows).tolist() == [len(w) for w in want]
    seen = {}
    for w, h in zip([x for ws in want for x in ws], hashes.tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_slices_and_sizes(monkeypatch):
    texts = ["abc def " * 50, "x", "y z" * 30]
    whole, _ = words.words(pa.array(texts))
    monkeypatch.setattr(words, "_STEP", 64)
    small, _ = words.words(pa.array(texts))
    assert (whole == small).all()
    sliced, _ = words.words(pa.array(["q", *texts]).slice(1))
    assert (whole == sliced).all()


# ---- 3 fingerprints ------------------------------------------------------------------------------------------


def test_edits_and_likeness(spark):
    texts = {1: "\n".join(f"line {i} of one with words {i * 7}" for i in range(20)), 4: "\n".join(f"other {i} row {i * 3}" for i in range(20)), 9: "", 12: "abcd"}
    docs = frame(spark, list(texts.items()))
    got = {r.doc_id: r for r in fingerprint.fingerprint_edits(docs).collect()}
    order = sorted(texts)
    for i, d in enumerate(order):
        t, nxt = texts[d], texts[order[(i + 1) % len(order)]]
        k = len(t) // 4
        edited = t[: len(t) - k] + nxt[:k]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert got[1].near_edited > 0.4 > 0.2 > got[1].near_next
    assert got[9].near_edited == 1.0 and got[9].fingerprint == got[9].edited_fingerprint


def test_order_plays_no_part_and_edits_are_sums(spark):
    rows = [(1, "a b c d\nx y\nz"), (2, "z\na b c d\nx y"), (3, "a b c d\nx y"), (4, "z"), (5, "z\nz\na b c d\nx y")]
    got = {r.doc_id: r for r in fingerprint.vectors(frame(spark, rows), ["doc_id"]).collect()}
    assert got[1].exact == got[2].exact and got[1].counts == got[2].counts and got[5].exact != got[1].exact
    pair = spark.createDataFrame([(got[3].exact, got[4].exact, got[1].exact)], "a array<long>, b array<long>, c array<long>")
    more, less = pair.select(fingerprint.combine(F.col("a"), F.col("b")), fingerprint.combine(F.col("c"), F.col("b"), -1)).collect()[0]
    assert more == got[1].exact and less == got[3].exact


def brute_fingerprint(text):
    def chain(*values):
        seed = 42
        for v in values:
            seed = xxhash.xxh64(struct.pack("<i", v) if isinstance(v, int) else v.encode(), seed=seed).intdigest()
        return seed

    exact, counts, units = [0] * 8, [0] * 64, 0
    for line in (text or "").split("\n"):
        for i, seed in enumerate(fingerprint.SEEDS):
            h = chain(seed, line)
            exact[2 * i] = (exact[2 * i] + (h & 0xFFFFFFFF)) % 2**32
            exact[2 * i + 1] = (exact[2 * i + 1] + (h >> 32)) % 2**32
        found = re.findall(r"[^\x20\x09-\x0D]+", line)
        for k in range(max(1, len(found) - 2) if found else 0):
            h = chain(*found[k : k + 3])
            units += 1
            for i in range(32):
                counts[i] += h >> i & 1
                counts[i + 32] += h >> (i + 32) & 1
    return exact, counts, units


def brute_likeness(a, b):
    x, y = ([2 * c - f[2] for c in f[1]] for f in (a, b))
    dot = lambda p, q: sum(u * v for u, v in zip(p, q, strict=True))
    both, total = dot(x, y), dot(x, x) + dot(y, y)
    return 1.0 if total == both == 0 else min(1.0, max(0.0, both / (total - both)))


def test_fingerprints_against_brute_force(spark):
    rng = random.Random(21)
    words_ = ["ein", "ß", "the", "of", "\u3000x", "a\tb", "!!"]
    texts = {i: "\n".join(" ".join(rng.choice(words_) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(1, 12))) for i in range(60)}
    texts |= {70: None, 71: "", 72: "\n\n \n", 73: "one", 74: LONG}
    got = {r.doc_id: r for r in fingerprint.fingerprint_edits(frame(spark, list(texts.items()))).collect()}
    order = sorted(texts)
    as_text = lambda f: "-".join(["".join(f"{v:08x}" for v in f[0]), f"{f[2]:x}", "".join(f"{v:08x}" for v in f[1])])
    for i, d in enumerate(order):
        t, nxt = texts[d] or "", texts[order[(i + 1) % len(order)]] or ""
        edited = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        own, after, following = map(brute_fingerprint, (t, edited, nxt))
        assert (got[d].fingerprint, got[d].edited_fingerprint) == (as_text(own), as_text(after))
        assert got[d].near_edited == pytest.approx(brute_likeness(own, after)) and got[d].near_next == pytest.approx(brute_likeness(own, following))
    both = spark.createDataFrame([(got[1].fingerprint, got[1].edited_fingerprint)], "a string, b string")
    a, b = fingerprint.lanes(F.col("a")), fingerprint.lanes(F.col("b"))
    assert both.select(fingerprint.likeness(a["counts"], a["units"], b["counts"], b["units"])).first()[0] == got[1].near_edited
    assert both.select(fingerprint.as_text(a["exact"], a["counts"], a["units"])).first()[0] == got[1].fingerprint


def test_insert_and_delete_are_the_fingerprint_of_the_whole(spark):
    lines = {1: ["a b c d e", "", "x"], 2: ["q"], 3: ["same same same same"]}
    more = {1: ["new line of words", "x"], 3: [""]}
    table = lambda d: frame(spark, [(i, "\n".join(v)) for i, v in d.items()])
    both = lambda df: {r.doc_id: (r.exact, r.counts, r.units) for r in df.collect()}
    before = fingerprint.vectors(table(lines), ["doc_id"])
    after = fingerprint.insert(before, table(more), ["doc_id"])
    assert both(after) == both(fingerprint.vectors(table({i: v + more.get(i, []) for i, v in lines.items()}), ["doc_id"]))
    assert both(fingerprint.delete(after, table(more), ["doc_id"])) == both(before)


def test_fingerprint_edges(spark):
    rows = fingerprint.fingerprint_edits(mixed(spark)).collect()
    assert len(rows) == 8 and sum(r.doc_id == 9 for r in rows) == 2
    by = collections.defaultdict(set)
    for r in rows:
        by[r.doc_id].add(r.fingerprint)
    assert by[5] == by[3] and by[7] == by[8]
    assert fingerprint.fingerprint_edits(mixed(spark).limit(0)).count() == 0
    assert fingerprint.fingerprint_edits(frame(spark, [(1, "abcdefgh")])).collect()[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


# ---- 4 exact dedup -------------------------------------------------------------------------------------------


def test_exact_dedup(spark):
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.decide(mixed(spark)).collect()}
    assert rows == {(5, 5, 2, True), (3, 5, 2, False), (7, 8, 2, False), (8, 8, 2, True), (9, 9, 2, True), (None, None, 1, True), (11, 11, 1, True)}
    kept = exact_dedup.dedup(mixed(spark))
    assert kept.columns == mixed(spark).columns
    assert sorted((r.doc_id or 0, r.digest) for r in kept.collect()) == [(0, "mine"), (5, "mine"), (8, "mine"), (9, "mine"), (11, "mine")]
    assert exact_dedup.decide(mixed(spark).limit(0)).count() == 0


def test_index_outlives_a_run(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    first = exact_dedup.DigestIndex(spark, path, buckets=3)
    first.add(frame(spark, [(1, "a"), (2, "a"), (3, "b")]))
    first.close()
    again = exact_dedup.DigestIndex(spark, path, buckets=3)
    new = frame(spark, [(4, "a"), (5, "c")])
    assert [r.keep_id for r in again.fresh(new).collect()] == [5]
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.decide(new, again).collect()} == {(4, 2, False), (5, 5, True)}
    plan = again.fresh(new)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_index_reopened_with_other_partitions(spark, tmp_path):
    """The bucket count is the index's own, whatever the session's shuffle partitions are; another one is refused."""
    texts, before = frame(spark, [(i, f"text {i}") for i in range(200)]), spark.conf.get("spark.sql.shuffle.partitions")
    path = f"file://{tmp_path}/index"
    exact_dedup.DigestIndex(spark, path, buckets=8).add(texts)
    try:
        for partitions in (3, 8, 16):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            index = exact_dedup.DigestIndex(spark, path)
            assert index.buckets == 8 and index.fresh(texts).count() == 0
            assert [r.keep_id for r in index.fresh(texts.union(frame(spark, [(900, "new")]))).collect()] == [900]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError, match="8 buckets"):
        exact_dedup.DigestIndex(spark, path, buckets=16)


def test_index_compacted(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    index = exact_dedup.DigestIndex(spark, path, buckets=2)
    for k in range(4):
        index.add(frame(spark, [(10 * k + i, f"t{(10 * k + i) % 25}") for i in range(10)]))
    rows = sorted(map(str, index.rows().collect()))
    index.compact()
    index.close()
    again = exact_dedup.DigestIndex(spark, path)
    assert again.generation == 1 and sorted(map(str, again.rows().collect())) == rows and len(rows) == 25
    assert again.fresh(frame(spark, [(1, "t3"), (2, "t99")])).count() == 1 and len(list((tmp_path / "index/data-1").glob("part-*"))) <= 2
    again.add(frame(spark, [(1, "t3"), (2, "t99")]))
    assert exact_dedup.DigestIndex(spark, path).rows().count() == 26


def test_leftovers_of_a_failed_compaction_do_not_count(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    exact_dedup.DigestIndex(spark, path, buckets=2).add(frame(spark, [(1, "a")]))
    spark.range(3).selectExpr("unhex('00') digest", "id keep_id", "id seen").write.parquet(f"{path}/data-1")
    assert [r.keep_id for r in exact_dedup.DigestIndex(spark, path).rows().collect()] == [1]


def test_clear_removes_what_was_written(spark, tmp_path, monkeypatch):
    from docframe.llm import _io

    monkeypatch.setattr(_io, "shared_dir", lambda _: f"file://{tmp_path}/shared")
    monkeypatch.setattr(_io, "_written", [])
    exact_dedup.dedup(mixed(spark)).count()
    assert list((tmp_path / "shared").iterdir()) and _io.clear(spark) > 0 and not list((tmp_path / "shared").iterdir()) and _io.clear(spark) == 0


# ---- 5 language model ----------------------------------------------------------------------------------------


def brute_lm(docs, held=1, prior=30.0, long_prior=0.5):
    tokens = {i: [w for w in (t or "").encode().lower().split()] + ["END"] for i, t in docs}
    train = [v for i, v in tokens.items() if zlib.crc32(str(i).encode()) % 5 != held]
    uni = collections.Counter(w for v in train for w in v)
    pairs = collections.Counter(p for v in train for p in zip(["START", *v[:-1]], v, strict=True))
    longs = collections.Counter(tuple(v[k : k + 5]) for v in train for k in range(len(v) - 4))
    contexts = collections.Counter()
    for g, c in longs.items():
        contexts[g[:4]] += c
    n, v = sum(uni.values()), len(uni)
    p = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    out = {}
    for i, t in tokens.items():
        score = 0.0
        for k, (h, w) in enumerate(zip(["START", *t[:-1]], t, strict=True)):
            c = len(train) if h == "START" else uni[h]
            chance = (pairs[h, w] + prior * p(w)) / (c + prior)
            if k >= 4:
                chance = (longs[tuple(t[k - 4 : k + 1])] + long_prior * chance) / (contexts[tuple(t[k - 4 : k])] + long_prior)
            score += np.log10(chance)
        out[i] = (len(t), sum(uni[w] > 0 for w in t), n, sum(np.log10(p(w)) for w in t), score)
    return out


def test_packed_numbers_come_back():
    rng = np.random.default_rng(4)
    for values in ([], [0], [255], [256, 2**63], rng.integers(0, 255, 1000), np.r_[rng.integers(0, 90, 999), 2**40], rng.integers(0, 2**24, 500), 2 ** rng.integers(0, 63, 300)):
        values = np.asarray(values, np.uint64)
        assert (lm_score._large(lm_score._small(values)) == values).all()
    keys = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64))
    assert (lm_score._keys(lm_score._deltas(keys)) == keys).all()


def test_strides_agree(monkeypatch):
    rng = np.random.default_rng(2)
    counts = np.array([40, 25, 10, 5, 0])
    machine = lm_score.BackoffAutomaton(counts, 80, 4, 7, 30.0)
    machine.add_pairs(np.array([1, 1, 2, machine.start]), np.array([1, 2, 0, 0]), np.array([30, 10, 25, 7]))
    machine.add_contexts(np.array([9]), np.array([1]), np.array([0, 0]), np.array([0, 3]), np.array([5, 4]), 0.5)
    rows = np.cumsum([0, *rng.integers(1, 40, 30), 700])
    word_of = rng.integers(0, 5, rows[-1])
    at = np.arange(rows[-1]) - np.repeat(rows[:-1], np.diff(rows))
    entered = np.where((at >= 4) & (rng.random(rows[-1]) < 0.3), machine.start + 1, 0)
    want = []
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        state, total = machine.start, 0.0
        for k in range(a, b):
            total += machine.step(np.array([entered[k] or state]), word_of[k : k + 1])[0]
            state = machine.target[word_of[k]]
        want.append(total)
    for stride in (1, 7, 256, 5000):
        monkeypatch.setattr(lm_score, "STRIDE", stride)
        assert machine.traverse(word_of, rows, entered) == pytest.approx(want)


def test_language_model_against_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("the a of cat Dog ß runs".split()) for _ in range(rng.randrange(40)))) for i in range(80)] + [(99, None), (100, "\n unseen words here"), (101, "w1 w2 w3 w4 w5 w6 w7"), (102, "w1 w2 w3 w4 w5 w6 w8")]
    got = {r.doc_id: r for r in lm_score.score(frame(spark, docs), shard_bytes=200, block_bytes=300).collect()}
    want = brute_lm(docs)
    for i, (n, known, total, base, score) in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(base, abs=1e-9) and r.score == pytest.approx(score, abs=1e-9)


def test_chances_after_every_state_sum_to_one():
    """Over all known words and the one unknown word that the model provides for."""
    words_ = np.array([40, 25, 10, 5, 0])
    machine = lm_score.BackoffAutomaton(words_, int(words_.sum()), 4, 7, 30.0)
    machine.add_pairs(np.array([1, 1, 2, 3, 4, machine.start]), np.array([1, 2, 0, 3, 0, 0]), np.array([30, 10, 25, 10, 5, 7]))
    state = machine.add_contexts(np.array([9, 0, 3]), np.array([1, 0, 2]), np.array([0, 0, 2]), np.array([0, 3, 3]), np.array([5, 4, 3]), 0.5)
    assert state.tolist() == [machine.start + 1, 0, machine.start + 2]
    for s in range(1, machine.start + 3):
        assert (10 ** machine.step(np.full(5, s), np.arange(5))).sum() == pytest.approx(1)


def test_language_model_edges(spark):
    assert lm_score.score(mixed(spark)).count() == 8 and lm_score.score(mixed(spark).limit(0)).count() == 0
    assert lm_score.score(frame(spark, [(9, "x y")]).where("doc_id < 0")).count() == 0


# ---- 6 near-duplicates ---------------------------------------------------------------------------------------


def brute_groups(texts, width, percent):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_groups_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, n = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 40, 120, 300]))]
        for _ in range(rng.randrange(1, 7)):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 25)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append((n * 37 % 1009, " ".join(own)))
            n += 1
    texts += [(2000, None), (2001, ""), (2002, " \n"), (2003, "two words"), (2004, "Two WORDS")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(frame(spark, texts), width=4).collect()}
    assert got == brute_groups(texts, 4, 80)


def test_bucket_of_several_groups_is_closed(spark, monkeypatch):
    """One bucket of pairs that are like each other and unlike its centre: every pair is found, in blocks too."""
    rng = random.Random(3)
    texts = []
    for k in range(14):
        base = [f"g{k}w{rng.randrange(10**6)}" for _ in range(rng.choice([5, 40, 90, 260]))]
        texts += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base + ["end"]))]
    monkeypatch.setattr(minhash, "band_keys", lambda signature: np.full((len(signature), 1), 7, np.uint64))
    for block in (1024, 5):
        monkeypatch.setattr(minhash, "BLOCK", block, raising=False)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(frame(spark, texts), width=4).collect()}
        want = brute_groups(texts, 4, 80)
        assert got == want and len({c for _, c in want.values()}) < len(texts)


def test_large_component_meets_the_others(spark, monkeypatch):
    """One bucket with a component of many near copies, pairs apart from it, and a text that only some copies link to."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(100)]
    texts = [(i, " ".join(base[: 100 - i % 5] + [f"t{i}"])) for i in range(40)]
    for k in range(6):
        own = [f"g{k}w{rng.randrange(10**6)}" for _ in range(60)]
        texts += [(100 + 2 * k, " ".join(own)), (101 + 2 * k, " ".join([*own, "end"]))]
    texts += [(200, " ".join(base[:88])), (201, " ".join(base[:76])), (202, " ".join(base[:50]))]
    monkeypatch.setattr(minhash, "band_keys", lambda signature: np.full((len(signature), 1), 7, np.uint64))
    monkeypatch.setattr(minhash, "BLOCK", 8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(frame(spark, texts)).collect()}
    want = brute_groups(texts, 5, 80)
    assert got == want and len({c for _, c in want.values()}) == 8


def test_dense_group_without_its_base(spark):
    """Texts made from one absent text, many of their pairs just below the likeness and some above."""
    rng = random.Random(5)
    base, texts = [f"b{i}" for i in range(150)], []
    for i in range(350):
        own = list(base)
        for _ in range(rng.randint(2, 5)):
            own[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        texts.append((i, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_groups(frame(spark, texts)).collect()}
    want = brute_groups(texts, 5, 80)
    assert got == want and 10 < len({c for _, c in want.values()}) < 340


def test_bitmaps_never_drop_a_pair_that_passes():
    rng = np.random.default_rng(4)
    for n in (1, 2, 9, 16, 17, 100, 129, 1000, 20000):
        items = rng.integers(0, 1 << 63, 2 * n).astype(np.uint64) * np.uint64(2)
        sets = [np.sort(items[:n]), *[np.sort(items[k : k + m]) for k, m in ((n // 12, n), (0, n + n // 4), (n // 5, n - n // 5), (n // 3, n))]]
        size = np.array([len(s) for s in sets])
        maps = [minhash.bitmap(s).tobytes() for s in sets]
        found = {frozenset(p) for x, y in minhash._near(np.arange(5), np.zeros(5), size, maps, 80) for p in zip(x.tolist(), y.tolist())}
        for a in range(5):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                assert 100 * both < 80 * (size[a] + size[b] - both) or frozenset((a, b)) in found
        assert n < 1000 or frozenset((0, 4)) not in found


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 300), (300, 400), (400, 200)]
    node = lambda x: int(words.mix(np.array([x], np.uint64)).view(np.int64)[0])
    links = [(node(a), node(b)) for a, b in links]
    labels = {r.node: r.label for r in minhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({labels[node(x)] for x in [*range(41), 100]}) == 1 and len({labels[node(x)] for x in (200, 300, 400)}) == 1 and len(set(labels.values())) == 2


def test_borrowing_keeps_agreement_near_likeness():
    rng = np.random.default_rng(0)
    agree = []
    for _ in range(200):
        items = rng.integers(0, 1 << 63, 12).astype(np.uint64) * np.uint64(2)
        a, b = np.sort(items[:10]), np.sort(np.r_[items[:8], items[10:]])
        s = minhash.signatures(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]))
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - 8 / 12) < 0.04


def test_near_dedup_edges(spark):
    kept = minhash.near_dedup(mixed(spark))
    assert kept.columns == mixed(spark).columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 7, 8, 9, 11]
    assert minhash.near_groups(mixed(spark).limit(0)).count() == 0


def test_near_dedup_keeps_unrelated_rows_of_one_id(spark):
    texts = [(None, "one two three four five six"), (None, "quite another text without an id"), (4, "the first of id four"), (4, "and the second of id four says more")]
    texts += [(6, " ".join(f"w{i}" for i in range(60))), (4, " ".join(f"w{i}" for i in range(61))), (4, "the first of id four")]
    kept = [(r.doc_id, r.text) for r in minhash.near_dedup(frame(spark, texts)).collect()]
    assert sorted(kept, key=repr) == sorted([*texts[:4], texts[5]], key=repr)
    groups = collections.Counter((r.doc_id, r.component_id, r.n_shingles) for r in minhash.near_groups(frame(spark, texts)).collect())
    assert groups == {(None, None, 2): 2, (4, 4, 1): 2, (4, 4, 4): 1, (6, 4, 56): 1, (4, 4, 57): 1}


CLASHES = "_salt _mask _set _first _least _row _n _c _all _l label uid th class first_uid digest _digest _keep keep_id _size _bucket _words _share _s _b _whole _copies _part _turn _before target source_size _target row rows bands size".split()


def clashing(spark):
    docs = frame(spark, [(5, "a b c"), (3, "a b c"), (7, None), (8, ""), (9, LONG), (9, LONG), (None, "only null id"), (11, "ß é x y z")])
    return docs.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in CLASHES])


@pytest.mark.parametrize("stage", [minhash.near_dedup, exact_dedup.dedup, mixing.mix, mixing.mix_whole], ids=lambda f: f.__name__)
def test_columns_that_clash_come_through(spark, stage):
    docs = clashing(spark)
    out = stage(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == c + ("-" if r.doc_id is None else str(r.doc_id)) for r in rows for c in CLASHES)


def test_columns_that_clash_are_no_input(spark):
    docs = clashing(spark)
    assert minhash.near_groups(docs).count() == exact_dedup.decide(docs).count() == mixing.assign(docs).count() == 8
    assert toxicity.ToxicityModel(None).apply(docs).count() == lm_score.score(docs).count() == fingerprint.fingerprint_edits(docs).count() == 8
    pages = docs.withColumnsRenamed({"doc_id": "page_id", "text": "html", "source": "url"}).drop("row")
    pages = pages.selectExpr("*", "1 AS archive", "2 AS frame", "3 AS payload", "4 AS refers_to", "5 AS record_type")
    assert warc.round_trip(pages).count() == 8 and packing.pack(docs).select("doc_id").distinct().count() == 7


# ---- 7 packing -----------------------------------------------------------------------------------------------


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(6)
    texts = [(i, " ".join(rng.choice(["alpha", "Beta", "γ", "12", "x<|endoftext|>y", "\n\n", "don't"]) for _ in range(rng.randrange(90)))) for i in range(80)] + [(90, None), (91, LONG)]
    rows = packing.pack(frame(spark, texts), window=64).collect()
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in texts:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    short = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
        short += at < 64
    assert short <= 1 and sorted(sequences) == list(range(len(sequences)))
    assert packing.pack(mixed(spark)).select("doc_id").distinct().count() == 7 and packing.pack(mixed(spark).limit(0)).count() == 0


def test_fit_reaches_a_known_mixture():
    combos = packing.combinations(16)
    assert combos.shape[1] == 4 and (combos.sum(1) == 16).all() and len(np.unique(combos, axis=0)) == len(combos)
    assert {tuple(c[:3]) for c in combos if c[2] and not c[3]} == {(16 - b - c, b, c) for b in range(1, 16) for c in range(1, b + 1) if 16 - b - c >= b}
    histogram = np.zeros(16, int)
    for n, k in ((10, 50), (6, 50), (8, 40)):
        histogram[n] += k
    kept = combos[((histogram[combos] > 0) | (combos == 0)).all(1)]
    x = packing.fit(histogram, kept)
    covered = sum(np.bincount(c, minlength=16) * n for c, n in zip(kept, x, strict=True))
    assert np.abs(covered - histogram)[1:].max() < 1 and (x >= 0).all()


@pytest.mark.parametrize(("most", "share"), [(1 << 16, 0.9), (4000, 0.6)])
def test_share_that_the_fit_places(most, share):
    rng = np.random.default_rng(5)
    for size in (10_000, 10_000_000):
        histogram = np.bincount(rng.lognormal(7, 0.9, 10_000).astype(int) % 2048, minlength=2048) * (size // 10_000)
        histogram[0] = 0
        plan = packing.Plan(histogram, 2048, 0, most)
        assert plan.used.sum() > share * histogram.sum() and (plan.used <= histogram).all()
        places = [piece[1:] for n in range(1, 2048) for r in range(min(3, int(histogram[n]))) for piece in plan.place(n, r)]
        assert len(set(places)) == len(places)


def test_ids_are_those_of_the_json_form():
    """Every text of sf0.01 and texts of random characters, against the tokenizers library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [t or "" for t in pa.parquet.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()]
    rng = random.Random(12)
    kinds = [(32, 127), (9, 14), (0xA0, 0x250), (0x300, 0x370), (0x600, 0x700), (0x2000, 0x2070), (0x3040, 0x30FF), (0x4E00, 0x9FFF), (0x1F300, 0x1F6FF)]
    texts += ["".join(chr(rng.randrange(*rng.choice(kinds))) for _ in range(rng.randrange(60))) for _ in range(3000)]
    assert [packing.encode(t) for t in texts] == [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


# ---- 8 mixing ------------------------------------------------------------------------------------------------


def test_targets_against_repeated_resharing(spark):
    rng = random.Random(2)
    for _ in range(5):
        sizes = {s: rng.choice([0, 3, 50, 1000, 20000]) for s in ["a", "b", "c", "é", "z", None]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        names = sorted((s for s in sizes if s), key=lambda s: [ord(c) for c in s]) + [None]
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        total, target, capped = sum(sizes.values()), {}, set()
        for _ in names:
            left = total - sum(3 * sizes[s] for s in capped)
            free = sum(weight[s] for s in names if s not in capped)
            target = {s: 3 * sizes[s] if s in capped else left * weight[s] / free for s in names}
            over = {s for s in names if target[s] > 3 * sizes[s]}
            if not over:
                break
            capped |= over
        assert got == pytest.approx(target)


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randrange(40)), "en", rng.choice(["a", "b", "c", None]), 0) for i in range(400)] + [(900, None, "en", "a", 0), (901, "", "en", "b", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.assign(docs).collect()
    assert len(got) == len(rows)
    taken = collections.Counter()
    for r in got:
        n = r._copies * r._size + r._part
        assert 0 <= n <= 3 * r._size and r._size == len((r.text or "").split())
        taken[r.source] += n
    for r in got:
        assert abs(taken[r.source] - r._target) <= 5
    mixture = mixing.mix(docs)
    words_of = collections.Counter()
    for r in mixture.collect():
        words_of[r.source] += len(r.text.split())
    assert words_of == taken and mixture.columns == docs.columns
    assert sorted(map(repr, mixing.assign(docs).collect())) == sorted(map(repr, got))
    assert mixing.assign(mixed(spark)).count() == 8 and mixing.mix(mixed(spark).limit(0)).count() == 0


def test_mix_in_whole_documents(spark):
    import corpus_pipeline

    rng = random.Random(3)
    rows = [(i, " ".join(f"w{k}" for k in range(rng.randrange(40))), "en", rng.choice(["a", "b", "c", None]), 0) for i in range(400)] + [(900, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    taken, target = collections.Counter(), {r.source: r._target for r in mixing.assign(docs).collect()}
    whole = {r[0]: r[1] for r in rows}
    got = corpus_pipeline.mix(spark, docs, "").collect()
    for r in got:
        assert r.text == whole[r.doc_id]
        taken[r.source] += len(r.text.split())
    assert all(abs(taken[s] - t) <= 25 for s, t in target.items())
    assert sorted(corpus_pipeline.mix(spark, docs, "").collect(), key=repr) == sorted(got, key=repr)


# ---- 9 archives ----------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def test_archives(spark, tmp_path):
    big = "<p>" + "ü" * 100_000
    rows = [(1, "http://a/1", "x" * 100), (2, "http://a/ü\r\nX: y", "x" * 100), (3, None, "small"), (4, "u", "small"), (5, "u", None), (6, "u", big), (7, "u", big), (None, "u", big)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit(1))
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(pages, folder, frame_bytes=300)
    got = {r.page_id: r for r in warc.read_archives(manifest, folder).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("response", None), 2: ("revisit", 1), 3: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None), 7: ("revisit", 6), None: ("revisit", 6),
    }
    for page, _, html in rows:
        body = (html or "").encode()
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
    place = manifest.where("page_id = 6").collect()[0]
    with pa.fs.LocalFileSystem().open_input_file(place.archive) as stream:
        record = warc.BundleReader(stream).record(place.frame, place.offset, place.length)
    assert record.startswith(b"WARC/1.1\r\n") and big.encode() in record
    assert warc.round_trip(pages.limit(0)).count() == 0
    small = warc.write_archives(pages.repartition(3), f"file://{tmp_path}/v", frame_bytes=1, archive_bytes=1)
    back = warc.read_archives(small, f"file://{tmp_path}/v")
    assert back.rdd.getNumPartitions() == small.select("archive").distinct().count() > 3 and back.count() == 8
    with pytest.raises((pa.ArrowInvalid, ValueError)):
        warc.write_archives(pages, "nosuch://store/x")


# ---- 2 and 10 classifiers ------------------------------------------------------------------------------------


def labelled(spark, n, bad, good):
    rng = random.Random(9)
    texts = [(i, " ".join([rng.choice(good) for _ in range(rng.randrange(8, 60))] + [rng.choice(bad) for _ in range(6 * (i % 2))])) for i in range(n)]
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(n)], "doc_id long, quality int, toxic int")
    return frame(spark, texts), labels


GOOD = "alpha beta gamma delta epsilon zeta eta theta".split()


def test_quality(spark):
    docs, labels = labelled(spark, 300, ["$$$", "junk%%%", "!!"], GOOD)
    model = quality.QualityModel.fit(docs, labels)
    rows = [r for r in model.apply(docs).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 0) for r in rows]) > 0.95
    assert model.apply(mixed(spark)).count() == 8 and model.keep(docs, 0.3).columns == docs.columns
    assert {r.score for r in quality.QualityModel.fit(docs, labels.limit(0)).apply(docs).collect()} == {0.5}
    parts, bias = quality.train(["good text"] * 4 + ["bad %%"] * 4, [1] * 4 + [0] * 4)
    assert (quality.score_texts(pa.array(["good text", "bad %%", None, ""]), parts, bias)[:2] > 0.5).tolist() == [True, False]


def test_toxicity_scores_against_plain_loops():
    """The score of a text written out word by word: input vectors, both recurrences, attention, the highest window."""
    p = {k: v.astype(np.float64) for k, v in toxicity.fresh(5).items()}
    p["word"] *= 8
    p["bias"][0] = 0.2
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "Bb", "ccc", "ééé", "longer-word", "x1"]) for _ in range(n)) for n in (0, 1, 5, 64, 65, 150)]
    shift = 64 - toxicity.TABLE_BITS

    def row(data, extra=0):
        h = words.hash_spans(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))
        return int(words.mix(h + np.uint64(extra))[0]) >> shift

    def vector(word):
        runs = []
        for width in (3, 4):
            for i in range(max(len(word) - width, 0) + 1):
                run = word[i : i + width]
                mark = (i == 0) + 2 * (i + len(run) == len(word))
                runs += [row(run)] + [row(run, mark)] * (mark > 0)
        return p["word"][row(word)] + np.mean([p["char"][r] for r in runs], axis=0)

    def side(name, xs):
        size, h, out = toxicity.HIDDEN, np.zeros(toxicity.HIDDEN), []
        for x in xs if name == "f" else xs[::-1]:
            a, u = x @ p[f"w{name}"] + p[f"c{name}"], p[f"u{name}"]
            z, r = (1 / (1 + np.exp(-(a[k * size : (k + 1) * size] + h @ u[:, k * size : (k + 1) * size]))) for k in (0, 1))
            c = np.tanh(a[2 * size :] + (r * h) @ u[:, 2 * size :])
            h = (1 - z) * h + z * c
            out.append(h)
        return out if name == "f" else out[::-1]

    want = []
    for t in texts:
        said, best = t.lower().encode().split(), -np.inf
        for first in range(0, max(len(said) - toxicity.WINDOW, 0) + toxicity.STRIDE, toxicity.STRIDE):
            xs = [vector(w) for w in said[first : first + toxicity.WINDOW]]
            states = [np.r_[f, b] for f, b in zip(side("f", xs), side("b", xs), strict=True)]
            weight = np.exp([s @ p["attend"] for s in states])
            pooled = sum(w * s for w, s in zip(weight / weight.sum(), states, strict=True)) if states else np.zeros(2 * toxicity.HIDDEN)
            best = max(best, pooled @ p["out"] + p["bias"][0])
        want.append(1 / (1 + np.exp(-best)))
    assert toxicity.score_texts(pa.array(texts), p) == pytest.approx(want, abs=1e-5)


def test_toxicity_gradients():
    """The written-out backward pass against differences of the forward pass."""
    p = {k: v.astype(np.float64) for k, v in toxicity.fresh(3).items()}
    own = toxicity.Words(pa.array(["a bb ccc dd", "ee a", ""]))
    _, first, size = toxicity.windows(own.rows)
    index = toxicity._index(own.word_of, first)
    vectors = own.inputs(p).astype(np.float64)
    slope = np.array([0.3, -0.7, 0.2])
    _, kept = toxicity.forward(p, vectors, index, size, keep=True)
    grads, d_vectors = toxicity.backward(p, vectors, kept, slope)
    rng = np.random.default_rng(1)
    for name in ("wf", "ub", "cf", "attend", "out", "uf"):
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in p[name].shape)
            change = []
            for step in (1e-3, -1e-3):
                q = p | {name: p[name].copy()}
                q[name][at] += step
                change.append(float(toxicity.forward(q, vectors, index, size)[0] @ slope))
            assert grads[name][at] == pytest.approx((change[0] - change[1]) / 2e-3, abs=2e-3)
    at = (1, 2)
    moved = [float(toxicity.forward(p, vectors + d * np.eye(len(vectors))[:, [at[0]]] * np.eye(vectors.shape[1])[at[1]], index, size)[0] @ slope) for d in (1e-3, -1e-3)]
    assert d_vectors[at] == pytest.approx((moved[0] - moved[1]) / 2e-3, abs=2e-3)


def test_toxicity(spark):
    rng = random.Random(7)
    texts, labels = [], []
    for i in range(240):
        own = [rng.choice(GOOD) + rng.choice(["", "s", "ed"]) for _ in range(rng.randrange(5, 150))]
        if i % 2:
            own[rng.randrange(len(own))] = rng.choice(["idiot", "moron", "scum"])
        texts.append(" ".join(own))
        labels.append(i % 2)
    p = toxicity.train(texts[:200], labels[:200], rounds=3, steps=40)
    score = toxicity.score_texts(pa.array([*texts[200:], None, ""]), p)
    assert np.mean((score[:-2] >= 0.5) == np.array(labels[200:])) > 0.9 and ((0 <= score) & (score <= 1)).all()
    assert {r.score for r in toxicity.ToxicityModel(None).apply(mixed(spark)).collect()} == {0.5}


def test_windows_cover_every_word():
    for n in (0, 1, 63, 64, 65, 112, 113, 500):
        _, first, size = toxicity.windows(np.array([0, n]))
        assert {x for a, k in zip(first, size, strict=True) for x in range(a, a + k)} == set(range(n))


def test_sample_is_bounded_and_held_out(spark):
    docs, labels = labelled(spark, 200, ["x"], GOOD)
    rows = labelled_rows(docs, labels, "toxic", 20, 10_000).collect()
    assert sorted(r._label for r in rows) == [0] * 20 + [1] * 20
    assert not any(zlib.crc32(str(r._id).encode()) % 5 == 0 for r in rows)


def test_sample_of_contradictions_and_repeats(spark):
    docs = frame(spark, [(1, "b"), (1, "a"), (2, "x"), (3, "y"), (4, "z" * 50), (6, None)])
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (2, 1), (3, 1), (4, 1), (6, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    rows = labelled_rows(docs, labels, "toxic", 20, 10, held_fold=9).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", 0), (3, "y", 1)]
