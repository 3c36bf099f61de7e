import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martwright.llm import decontaminate, minhash, repeats
from martwright.llm.components import components
from tests.llm.helpers import LINE, awkward, clashing, docs


def brute_components(rows):
    """Smallest id per linked group, from all pairs."""
    sets = {}
    for i, t in rows:
        words = (t or "").lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    return group, {i: len(s) for i, s in sets.items()}


def edited(random_, words, edits):
    words = list(words)
    for _ in range(edits):
        words[random_.randrange(len(words))] = f"e{random_.random()}"
    return " ".join(words)


def test_near_duplicates_equal_all_pairs(spark):
    r = random.Random(4)
    rows, number = [], 0
    for size in (40, 6, 3, 2, 1, 1):
        base = [f"w{r.randrange(500)}" for _ in range(r.randint(60, 200))]
        for _ in range(size):
            rows.append((number, edited(r, base, r.randint(0, 3))))
            number += 1
    rows += [(number, "two words"), (number + 1, "Two  words"), (number + 2, "one"), (number + 3, "x y z u v w")]
    r.shuffle(rows)
    group, sizes = brute_components(rows)
    found = {x["doc_id"]: x for x in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert {i: x["component_id"] for i, x in found.items()} == group
    assert {i: x["n_shingles"] for i, x in found.items()} == sizes
    assert all(x["kept"] == (i == group[i]) for i, x in found.items())


def test_pairs_on_a_shared_template_are_all_linked(spark):
    """Groups 0.69 alike through a template, each a pair at 0.78: no center links most of them."""
    rows = []
    for g in range(120):
        shared, words = [f"t{k}" for k in range(250)], [f"g{g}x{k}" for k in range(18)]
        for i in (g, 1000 + (g * 37) % 120):
            rows.append((i, " ".join(shared[:100] + words + [f"d{i}x{k}" for k in range(32)] + shared[100:])))
    group, _ = brute_components(rows)
    assert len(set(group.values())) == 120
    found = {x["doc_id"]: x["component_id"] for x in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert found == group


def test_densification_fills_every_bin_alike():
    values = minhash.bins(minhash.shingle_set("a b c d e f"))
    assert len(values) == minhash.BINS and len(set(values.tolist())) == 2
    assert (minhash.bins(minhash.shingle_set("A B c d e f")) == values).all()


def test_near_duplicates_on_awkward_rows(spark):
    found = minhash.near_duplicates(awkward(spark)).collect()
    assert len(found) == 10
    by = {x["doc_id"]: x for x in found}
    assert by[5]["component_id"] == 1 and not by[5]["kept"] and by[1]["kept"]
    assert by[2]["n_shingles"] == 0 and by[2]["component_id"] == 2 and by[2]["kept"]
    assert by[None]["component_id"] is None and by[None]["kept"]
    assert minhash.near_duplicates(awkward(spark).limit(0)).count() == 0
    assert minhash.near_duplicates(clashing(spark, [(1, LINE), (2, LINE)])).where("kept").count() == 1


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 9), (9, 8)]
    r = random.Random(1)
    r.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {x["id"]: x["component"] for x in found} == {i: 100 for i in range(100, 161)} | {7: 7, 8: 7, 9: 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_removed(rows):
    first = {}
    for i, t in rows:
        for k in range(len(t) - 49):
            first[t[k : k + 50]] = min(first.get(t[k : k + 50], i), i)
    out = {}
    for i, t in rows:
        gone = [False] * len(t)
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                gone[k : k + 50] = [True] * 50
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[i] = kept, sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
    return out


def test_repeats_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 2000)
    r = random.Random(3)
    parts = ["the ", "of ", "a", "é", "\n", "xyz ", "Ber ", "0"]
    base = ["".join(r.choice(parts) for _ in range(r.randint(30, 150))) for _ in range(5)]
    rows = []
    for i in range(60):
        text = list(r.choice(base) + r.choice(["", r.choice(base), "Ber " * 60]))
        for _ in range(r.randint(0, 3)):
            text[r.randrange(len(text))] = r.choice("abQ é")
        rows.append((i, "".join(text)))
    r.shuffle(rows)
    want = brute_removed([(i, t.encode()) for i, t in rows])
    given = docs(spark, rows).repartition(5)
    import hashlib

    for x in repeats.removal_report(given).collect():
        kept, spans = want[x["doc_id"]]
        assert x["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert (x["n_spans"], x["n_removed"]) == (spans, x["n_bytes"] - len(kept))
    for x in repeats.without_repeats(given).collect():
        assert x["text"] == want[x["doc_id"]][0].decode("utf-8", "ignore")


def test_common_prefixes_equal_direct_comparison():
    r = random.Random(9)
    texts = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 200))) for _ in range(20)]
    texts += [texts[0], texts[1] + b"b", b"ab" * 60]
    data = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
    order, shared = repeats.common_prefixes(data)
    whole = data.tobytes()
    for k in range(1, len(data)):
        a, b = whole[order[k - 1] : order[k - 1] + 50], whole[order[k] : order[k] + 50]
        if b"\xff" in a or b"\xff" in b or len(b) < 50:
            continue
        same = next((i for i in range(50) if a[i] != b[i]), -1)
        assert shared[k] == same


def test_pieces_hold_every_passage_once_and_equal_passages_share_an_anchor(monkeypatch):
    monkeypatch.setattr(repeats, "HASHED_PLACES", 128)
    r = random.Random(4)
    texts = [bytes(r.choice(b"abcdefgh ") for _ in range(size)) for size in (50, 51, 83, 84, 85, 700, 49, 0, 1)]
    texts += [b"x" * 400, b"ab" * 90, texts[5][100:400], b"yy" + texts[5][37:], b"x" * 50]
    pieces = repeats.cut_pieces([(i, 1000 * i, t) for i, t in enumerate(texts)])
    anchors, seen, by_passage = pieces.anchors(), [], {}
    for k in range(len(pieces)):
        doc, at, size, begin = int(pieces.doc[k]), int(pieces.at[k]), int(pieces.size[k]), int(pieces.begin[k])
        at -= 1000 * doc
        assert repeats.MIN_BYTES <= size <= repeats.LONGEST
        assert pieces.data[begin : begin + size].tobytes() == texts[doc][at : at + size]
        for start in range(at, at + size - repeats.MIN_BYTES + 1):
            seen.append((doc, start))
            by_passage.setdefault(texts[doc][start : start + repeats.MIN_BYTES], set()).add(int(anchors[k]))
    assert sorted(seen) == [(i, p) for i, t in enumerate(texts) for p in range(len(t) - repeats.MIN_BYTES + 1)]
    assert all(len(found) == 1 for found in by_passage.values())


def test_hashes_of_a_unit_stay_small():
    r = np.random.default_rng(3)
    text = r.integers(97, 123, 1 << 20, dtype=np.uint8).tobytes()
    tracemalloc.start()
    try:
        repeats.cut_pieces([(1, 0, text)])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # One hash of eight bytes for each place, and what tells neighbours apart.
    assert peak < 32 * len(text)


def test_large_transforms_are_split_by_anchor(spark, monkeypatch):
    monkeypatch.setattr(repeats, "TRANSFORM_BYTES", 300)
    monkeypatch.setattr(repeats, "UNIT_BYTES", 900)
    pieces = repeats.cut_pieces([(i, 0, (f"{i} " + LINE * 3).encode()) for i in range(9)])
    found, starts, ends = repeats.find_spans(pieces)
    assert set(found.doc.tolist()) == set(range(1, 9))


def chance_neighbours(n, r, shared=(17, 20, 35, 45, 52, 70)):
    """Texts that share a line, or some words of it, behind and before other words."""
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(300)]

    def some(k):
        return " ".join(r.choice(words) for _ in range(k))

    line = LINE[:70]
    return [f"{some(12)} {line[:r.choice(shared)]} {some(12)}".encode() for _ in range(n)]


def removed_by_spans(pieces, texts):
    found, starts, ends = repeats.find_spans(pieces)
    gone = {i: [False] * len(t) for i, t in enumerate(texts)}
    for i, a, b in zip(found.doc.tolist(), (found.at + starts).tolist(), (found.at + ends).tolist()):
        gone[i][a:b] = [True] * (b - a)
    return {i: bytes(c for c, g in zip(t, gone[i]) if not g) for i, t in enumerate(texts)}


def test_pieces_alike_only_around_their_anchor_are_not_transformed(monkeypatch):
    texts = chance_neighbours(400, random.Random(6), [17] * 4 + [20] * 4 + [24] * 4 + [35, 70])
    want = {i: kept for i, (kept, _) in brute_removed(list(enumerate(texts))).items()}
    pieces = repeats.cut_pieces([(i, 0, t) for i, t in enumerate(texts)])
    sizes, transform = [], repeats.repeated_starts
    monkeypatch.setattr(repeats, "repeated_starts", lambda p: sizes.append(int(p.size.sum())) or transform(p))
    assert removed_by_spans(pieces, texts) == want
    compared = sum(sizes)
    _, group, count = np.unique(pieces.anchors(), return_inverse=True, return_counts=True)
    assert 0 < compared < pieces.size[count[group] > 1].sum() / 2


def test_one_anchor_of_many_pieces_is_split_between_transforms(monkeypatch):
    monkeypatch.setattr(repeats, "TRANSFORM_BYTES", 4000)
    r = random.Random(8)
    texts = [bytes(r.choice(b"abcdefgh") for _ in range(60)) + LINE[:70].encode() for _ in range(400)]
    texts += [t + bytes(r.choice(b"abcdefgh") for _ in range(60)) for t in chance_neighbours(200, r)]
    want = {i: kept for i, (kept, _) in brute_removed(list(enumerate(texts))).items()}
    pieces = repeats.cut_pieces([(i, 0, t) for i, t in enumerate(texts)])
    sizes, transform = [], repeats.repeated_starts
    monkeypatch.setattr(repeats, "repeated_starts", lambda p: sizes.append(int(p.size.sum())) or transform(p))
    assert removed_by_spans(pieces, texts) == want
    assert sizes and max(sizes) < 2 * repeats.TRANSFORM_BYTES


def test_units_are_dealt_together(monkeypatch):
    monkeypatch.setattr(repeats, "UNIT_BYTES", 2000)
    texts = [t.decode() for t in chance_neighbours(60, random.Random(2))]
    texts[3:3] = texts[:3]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    rows = [x for b in repeats._cut(3)(iter([batch])) for x in b.to_pylist()]
    units = -(-sum(map(len, texts)) // 2000)
    sent = [x for x in rows if not x["local"]]
    assert units > repeats.DEALT_UNITS
    assert len(sent) <= 3 * -(-units // repeats.DEALT_UNITS)
    assert any(x["local"] for x in rows)
    cuts = repeats.cut_pieces([(i, 0, t.encode()) for i, t in enumerate(texts)])
    seen = repeats.unpack([x["pieces"] for x in rows])
    for name in ("doc", "at", "size"):
        assert sorted(getattr(seen, name).tolist()) == sorted(getattr(cuts, name).tolist())


def test_repeats_on_awkward_rows(spark):
    found = repeats.removal_report(awkward(spark)).collect()
    assert len(found) == 10
    by = {x["doc_id"]: x for x in found}
    assert by[5]["n_removed"] == len(LINE) * 3 and by[5]["n_spans"] == 1
    assert by[1]["n_removed"] == by[None]["n_removed"] == by[2]["n_bytes"] == by[6]["n_removed"] == 0
    assert repeats.removal_report(awkward(spark).limit(0)).count() == 0
    two = clashing(spark, [(1, LINE), (2, LINE)])
    assert sorted(x["text"] for x in repeats.without_repeats(two).collect()) == ["", LINE]
    assert repeats.without_repeats(two).columns == two.columns
    same = docs(spark, [(1, LINE), (1, "x" + LINE), (2, "zz" + LINE)])
    assert sorted(x["n_removed"] for x in repeats.removal_report(same).collect()) == [0, 0, len(LINE)]


ITEM = "Which of these rivers flows through the old town before it meets the sea near the harbour?"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bit_parallel_distance_equals_the_matrix():
    r = random.Random(3)
    for _ in range(400):
        p = "".join(r.choice("abc") for _ in range(r.randint(1, 12)))
        t = "".join(r.choice("abc") for _ in range(r.randint(0, 20)))
        d, a, b = decontaminate.Pattern(p, len(p)).find(t)
        best = min(distance(p, t[i:j]) for i in range(len(t) + 1) for j in range(i, len(t) + 1))
        assert d == best == distance(p, t[a:b])


def test_leaks_are_found_within_the_budget(spark):
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, ""), (10, "too short"), (None, "z" * 40)], "item_id long, text string")
    budget = int(len(ITEM) * decontaminate.ERROR_RATE)
    r = random.Random(5)
    rows = [(0, LINE + ITEM + LINE), (1, LINE + ITEM.upper().replace(" ", " \n ") + LINE), (2, LINE * 5), (3, None), (4, "")]
    for k in range(40):
        text = list(ITEM)
        for _ in range(k % (2 * budget)):
            at = r.randrange(len(text))
            text[at] = r.choice(["", "#", text[at] + "#"])
        rows.append((100 + k, LINE + "".join(text) + LINE))
    found = decontaminate.find_leaks(docs(spark, rows), items).collect()
    by = {x["doc_id"]: x for x in found}
    normal = decontaminate.normal(ITEM)
    for i, t in rows:
        t = decontaminate.normal(t or "")
        near = min((distance(normal, t[a : a + len(normal) + e]) for a in range(60, min(len(t), 100)) for e in range(-budget, budget + 1)), default=99)
        assert (i in by) == (near <= budget)
        if i in by:
            assert by[i]["distance"] == near
    text = dict(rows)[1]
    assert text[by[1]["start"] : by[1]["end"]] == ITEM.upper().replace(" ", " \n ")
    left = decontaminate.without_leaks(docs(spark, rows), items)
    assert left.where(F.col("doc_id").isin(*by)).count() == 0 and left.count() == len(rows) - len(by)


def test_short_items_are_found_whole_between_word_borders(spark):
    items = spark.createDataFrame([(1, "Who wrote  Faust?"), (2, "art"), (3, "谁写了它"), (4, " ")], "item_id long, text string")
    rows = [
        (0, f"So: who\nwrote FAUST? {LINE}"), (1, "who wrote fausts?"), (2, "xwho wrote faust?"), (3, "a cart, then: Art!"),
        (4, "party cart"), (5, "他问谁写了它吗"), (6, "who wrote faust"),
    ]
    found = decontaminate.find_leaks(docs(spark, rows), items).collect()
    texts = {(x["doc_id"], x["item_id"]): dict(rows)[x["doc_id"]][x["start"] : x["end"]] for x in found}
    assert texts == {(0, 1): "who\nwrote FAUST?", (3, 2): "Art", (5, 3): "谁写了它"}
    assert all(x["distance"] == 0 for x in found)
    left = decontaminate.without_leaks(docs(spark, rows), items).collect()
    assert {x["doc_id"] for x in left} == {1, 2, 4, 6}


def test_leaks_in_blocks_and_awkward_rows(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"{i} {ITEM}") for i in range(6)], "item_id long, text string")
    whole = decontaminate.find_leaks(docs(spark, [(1, f"3 {ITEM}")]), items).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    parts = decontaminate.find_leaks(docs(spark, [(1, f"3 {ITEM}")]), items).collect()
    assert sorted(whole) == sorted(parts) and len(whole) == 6
    assert decontaminate.find_leaks(awkward(spark), items).count() == 0
    assert decontaminate.without_leaks(awkward(spark), items).count() == 10
    assert decontaminate.find_leaks(awkward(spark).limit(0), items).count() == 0
    assert decontaminate.find_leaks(awkward(spark), items.limit(0)).count() == 0
    odd = clashing(spark, [(1, ITEM), (2, "x")])
    assert decontaminate.without_leaks(odd, items).columns == odd.columns
