"""Phrase collocations, spelling variants and toxicity on small tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright.llm import collocations, spelling, toxicity
from tests.llm.helpers import DOCS, LINE, awkward, clashing, docs


def brute_collocations(rows, top, threshold, percent):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        pieces = [lowered]
        for mark in ".,;:!?\n\x0b\x0c\r":
            pieces = [p for piece in pieces for p in piece.split(mark)]
        for piece in pieces:
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        frequent = {g: a for g, a in f.items() if len(g) > 1 and a >= threshold}
        told = []
        for gram, a in frequent.items():
            longer = [b for g, b in frequent.items() if len(g) == 3 > len(gram) and gram in (g[:2], g[1:])]
            if any(100 * b >= percent * a for b in longer):
                continue
            cuts = [(1000000 * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            told.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(told)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def random_texts(seed, rows=150):
    random.seed(seed)
    words = ["Aa", "b", "é", "c d", "x1", "ÿ", "the", "e"]
    make = lambda: "".join(random.choice(words) + random.choice("  \t.\n,;!?\r") for _ in range(random.randint(0, 60)))
    return [(random.choice([make(), None, "", "the the the the", "b"]), random.choice(["en", "en", "de", None])) for _ in range(rows)]


@pytest.mark.parametrize("chunk", [1 << 20, 7])
def test_collocations_equal_brute_force(spark, monkeypatch, chunk):
    rows = random_texts(chunk)
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(rows)], DOCS)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", chunk)
    found = collocations.collocations(df.repartition(3), top=15, threshold=10, percent=50)
    assert sorted(tuple(r) for r in found.collect()) == brute_collocations(rows, 15, 10, 50)


def test_chunks_cut_inside_a_piece_lose_nothing():
    vocabulary, stream = [b".", b"a", b"b", b"c"], np.array([1, 2, 3, -1, 1, 2, 3, 1, -1], np.int32)
    whole = Counter()
    for size in (1, 2, 3, 4, 100):
        collocations.CHUNK_WORDS, before = size, collocations.CHUNK_WORDS
        try:
            grams = Counter()
            for row in collocations._chunk_rows("en", vocabulary, stream):
                words, part = collocations._opened(row)
                for n, places in enumerate(collocations._places(part, row["starts"]), 1):
                    grams.update(tuple(words[i] for i in part[p : p + n]) for p in places)
        finally:
            collocations.CHUNK_WORDS = before
        whole = whole or grams
        assert grams == whole and grams[(b"a", b"b", b"c")] == 2 and (b"c", b"a", b"b") not in grams


@settings(max_examples=60, deadline=None)
@given(
    items=st.lists(st.integers(0, 40), min_size=1, max_size=400),
    parts=st.integers(1, 9), threshold=st.integers(1, 12), skewed=st.booleans(),
)
def test_merged_summaries_keep_whatever_reaches_the_threshold(items, parts, threshold, skewed):
    items = [i % 3 if skewed and i % 2 else i for i in items]
    summary = collocations.Summary(len(items) // threshold + 1)
    for part in range(parts):
        keys, counts = np.unique(np.array(items[part::parts], np.uint64), return_counts=True)
        summary.merge(keys, counts)
    kept = set(summary.reaching(threshold).tolist())
    assert {k for k, n in Counter(items).items() if n >= threshold} <= kept
    assert len(summary.keys) <= summary.capacity and summary.cut < threshold


def test_a_summary_forgets_what_is_rare():
    summary = collocations.Summary(1000 // 10 + 1)
    for part in range(10):
        rare = np.arange(part * 90, part * 90 + 90)
        keys, counts = np.unique(np.append(rare, [5000] * 10).astype(np.uint64), return_counts=True)
        summary.merge(keys, counts)
    assert summary.reaching(10).tolist() == [5000]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, (1 << collocations.KEY_BITS) - 1), max_size=50, unique=True))
def test_keys_survive_their_encoding(keys):
    sorted_keys = np.array(sorted(keys), np.uint64)
    assert collocations._decoded(collocations._encoded(sorted_keys)).tolist() == sorted(keys)


def test_equal_hashes_only_let_more_survive(spark, monkeypatch):
    rows = random_texts(5)
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(rows)], DOCS)
    mixed = collocations._hashed

    def colliding(*args):
        return [keys & np.uint64((1 << 45) | (1 << 46)) for keys in mixed(*args)]

    counted = collocations.frequent_phrases
    chunks = collocations.chunked(df).persist()
    exact = {tuple(r) for r in counted(chunks, 10).collect()}
    monkeypatch.setattr(collocations, "_hashed", colliding)
    places = collocations._summaries(chunks, 3).count()
    assert places <= 4 * chunks.count() and exact


def test_collocations_on_awkward_rows(spark):
    found = collocations.collocations(awkward(spark), threshold=2)
    assert [r["score"] for r in found.where("phrase = 'quick brown fox'").collect()] == [1000000]
    assert found.where("phrase = 'quick brown'").count() == 0  # stands in the longer phrase only
    assert collocations.collocations(awkward(spark).limit(0)).count() == 0
    odd = collocations.collocations(clashing(spark, [(1, "a b. " * 12)]))
    assert [tuple(r) for r in odd.collect()] == [("en", 1, "a b", 12, 12, 12, 24, 1000000)]


# -- spelling --------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = Counter()
    import re

    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[word] = best if best is not None and words[best] >= 5 * words[word] else None
    out = []
    for word, n in words.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), words.get(form[word])))
    return sorted(out, key=repr)


def variant_texts(seed):
    """Few letters make many neighbours; counts fall steeply, so that forms make chains."""
    random.seed(seed)
    base = ["abcabca", "abéabé", "AAAAAA", "bbbbbbbbb", "ÿÿÿÿÿÿÿ", "a×b÷cd"]
    rows = []
    for id in range(400):
        words = []
        for _ in range(40):
            word = random.choice(base)
            for _ in range(random.choice([0, 0, 0, 0, 1, 1, 2])):
                at = random.randrange(len(word) + 1)
                word = random.choice([word[:at] + word[at + 1 :], word[:at] + random.choice("abé") + word[at + random.randint(0, 1) :]])
            words.append(word)
        rows.append((id if id % 9 else None, random.choice([" ", "-", "1"]).join(words)))
    chain = "abcdefg " * 250 + "abcdefgh " * 40 + "abcdefghi " * 6
    return [*rows, (7, None), (8, ""), (1001, chain)]


@pytest.mark.parametrize("block", [2048, 3])
def test_variants_equal_brute_force(spark, monkeypatch, block):
    rows = variant_texts(block)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    found = spelling.spelling_variants(docs(spark, rows).repartition(3))
    expected = brute_variants(rows)
    assert len(expected) > 50 and any(r[2] not in (r[0], r[1]) for r in expected)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=5, max_size=9), min_size=2, max_size=12, unique=True))
def test_each_pair_is_found_once_on_one_side(words):
    found = Counter()
    for longer in range(6, 11):
        for side in (0, 1):
            half = longer // 2
            groups = defaultdict(list)
            for word in words:
                if len(word) in (longer, longer - 1):
                    groups[word[:half] if side == 0 else word[len(word) - half :]].append(word)
            for group in groups.values():
                a, b = spelling.neighbours(group, group, longer, side)
                found.update((group[i], group[j]) for i, j in zip(a, b) if i != j)
    assert found == Counter({(a, b): 1 for a in words for b in words if a != b and one_edit(a, b) and max(len(a), len(b)) >= 6})


def test_variants_on_awkward_rows(spark):
    found = {r["word"]: r for r in spelling.spelling_variants(awkward(spark).unionByName(docs(spark, [(9, "letter " * 9 + "letters " * 60)]))).collect()}
    assert found["letter"]["form"] == found["letter"]["root"] == "letters" and found["letters"]["form"] is None
    assert "é" * 3000 not in found
    assert spelling.spelling_variants(awkward(spark).limit(0)).count() == 0
    assert spelling.spelling_variants(clashing(spark, [(1, "letter " * 9)])).count() == 1
    long = "é" * 300
    twice = spelling.spelling_variants(docs(spark, [(1, f"{long} " * 40 + f"{long}é " * 5)])).collect()
    assert {(len(r["word"]), r["n_near"]) for r in twice} == {(300, 1), (301, 1)}


# -- toxicity --------------------------------------------------------------------------


def toxic_training(spark):
    random.seed(2)
    calm = [(i, f"{LINE} part {i} of a long and quiet story. " * 2, 0) for i in range(200)]
    rude = [(1000 + i, f"{LINE} you utter {random.choice(['blockhead', 'dunderhead'])} number {i}", 1) for i in range(60)]
    rows = docs(spark, [(i, t) for i, t, _ in calm + rude])
    return rows, spark.createDataFrame([(i, 1, t) for i, _, t in calm + rude], "doc_id long, quality int, toxic int")


def test_toxicity_separates_and_repeats(spark):
    rows, labels = toxic_training(spark)
    model = toxicity.fit(rows, labels)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(rows, model).collect()}
    assert min(found[1000 + i] for i in range(60)) > 0.7 > 0.3 > max(found[i] for i in range(200))
    again = toxicity.fit(rows.repartition(3), labels)
    assert np.array_equal(model.kept, again.kept) and np.allclose(model.weights, again.weights)
    hidden = docs(spark, [(1, LINE * 20_000 + "what a blockhead"), (2, LINE * 20_000)])
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(hidden, model).collect()}
    assert scores[1] > scores[2]


def test_features_and_scores_equal_a_plain_loop(spark, monkeypatch):
    rows, labels = toxic_training(spark)
    model = toxicity.fit(rows, labels)
    text = "Ein  Ünsinn\tund 😀 blockhead\n" + LINE
    clean = " " + " ".join(text.lower().split()) + " "

    plain = set()
    for size in toxicity.SIZES:
        for i in range(len(clean) - size + 1):
            run = ord(clean[i])
            for c in clean[i + 1 : i + size]:
                run = (run * 1_000_003 + ord(c)) % (1 << 64)
            plain.add(((run + size) * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - toxicity.BUCKET_BITS))
    assert toxicity.buckets(text).tolist() == sorted(plain)
    weights = dict(zip(model.kept.tolist(), model.weights.tolist()))
    logit = model.bias + sum(weights.get(b, 0.0) for b in plain)
    assert model.probability(text) == pytest.approx(1 / (1 + np.exp(-logit)))
    monkeypatch.setattr(toxicity, "WINDOW", 5)
    assert toxicity.buckets(text).tolist() == sorted(plain)


def test_the_fit_ends_near_the_least_loss():
    y = np.array([i % 2 for i in range(2400)], float)
    rows = [np.array([0, 1 + i % 3] if (i % 2) ^ (i % 24 == 0) else [3 + i % 3], np.int64) for i in range(2400)]
    ratios = np.array([2.0, 1.5, 1.5, 1.0, -1.5, -1.5])
    weights, bias = toxicity.train(rows, y, np.ones(len(y)), ratios)

    def loss(w, b):
        z = np.array([(w[r] * ratios[r]).sum() + b for r in rows])
        return np.mean(np.logaddexp(0, z) - y * z) + toxicity.DECAY / 2 * (w @ w)

    assert loss(weights, bias) < 0.3 < loss(weights * 0, 0.0)
    for at in range(len(weights)):
        step = np.eye(len(weights))[at] * 1e-4
        assert abs(loss(weights + step, bias) - loss(weights - step, bias)) / 2e-4 < 0.05


def test_held_out_toxicity_on_given_tables(spark):
    from martwright.llm.queries import QUERIES

    sf = "/root/testdata/sf0.1"
    found = QUERIES["op13_toxicity"](spark, sf)
    rows = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    caught = sum(r["predicted"] for r in held if r["toxic"]) / sum(r["toxic"] for r in held)
    wrong = sum(r["predicted"] for r in held if not r["toxic"]) / sum(1 - r["toxic"] for r in held)
    assert caught > 0.75 and wrong < 0.005
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_toxicity_on_awkward_rows(spark):
    rows, labels = toxic_training(spark)
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 0), (1, 1, None), (2, 0, 0), (3, 0, 7)], labels.schema))
    model = toxicity.fit(rows, odd)
    assert toxicity.score(awkward(spark), model).where(F.col("score").between(0, 1)).count() == 10
    blank = toxicity.fit(rows.limit(0), labels.limit(0))
    assert toxicity.score(rows.limit(3), blank).select("score").distinct().collect() == [(0.5,)]
    one = toxicity.fit(rows, labels.where("toxic = 0"))
    assert toxicity.score(rows, one).agg(F.max("score")).first()[0] < 1e-9
    assert toxicity.score(rows.limit(0), model).count() == 0
    assert toxicity.score(clashing(spark, [(1, "a b")]), model).columns == ["doc_id", "score"]
