import hashlib
import random
import struct
import zlib
from array import array

import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from martwright.llm import chat, language_id, packing, token_counts, warc
from tests.llm.helpers import LINE, awkward, clashing, docs

PARTS = [
    "a", "The", " ", "  ", "\n", "\t", "'s", "'RE", "'", "r", "!", "??", "12", " x", "<|endoftext|>", "<|endo",
    "é", "ü ", "日本", "\x1c", "====", "👍", "́", "\r\n", "I'll", "ſ", "\x85", "²", "Σ", "İ", "\x00", "_",
]


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(n)]


def test_token_counts_at_every_prefix_equal_the_library():
    counter = token_counts.counter(public_tokenizers.path("byte_bpe_50k.json"))
    count = lambda t: len(counter.library.encode(t, add_special_tokens=False).ids)
    for text in odd_texts(800, 1):
        assert counter.count(text) == count(text)
        assert counter.at_every_prefix(text) == [count(text[:i]) for i in range(len(text) + 1)]


def test_token_counts_of_given_documents_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    library = token_counts.counter(path).library
    for row in token_counts.token_counts(given, path, 512).collect():
        n = len(library.encode(texts[row["doc_id"]], add_special_tokens=False).ids)
        assert (row["n_tokens"], row["over_limit"]) == (n, n > 512)
        assert row["n_bytes"] == len(texts[row["doc_id"]].encode())


def test_token_counts_on_awkward_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = token_counts.token_counts(awkward(spark), path, 3).collect()
    assert len(found) == 10
    assert all(r["n_tokens"] == 0 and not r["over_limit"] for r in found if r["doc_id"] in (2, 3))
    assert token_counts.token_counts(awkward(spark).limit(0), path, 3).count() == 0
    assert token_counts.token_counts(clashing(spark, [(1, "a b")]), path, 1).first()["over_limit"]
    table = token_counts.prefix_table(docs(spark, [(1, "a bc d"), (2, None)]), path).orderBy("doc_id").collect()
    assert table[1]["counts"] == [0] and len(table[0]["counts"]) == 7
    assert token_counts.longest_prefix(table[0]["counts"], 2) == 4


def test_word_ids_equal_the_library():
    encoder = packing.encoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in odd_texts(3000, 2):
        ids = encoder.library.encode(text, add_special_tokens=False).ids
        assert array("I", encoder.text(text)).tolist() == ids


def test_words_with_accents_need_no_call_of_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = packing.WordEncoder(path), packing.WordEncoder(path).library
    letters = [chr(c) for c in range(0xA1, 0x100)]
    chunks = [f"{a}{b}" for a in letters for b in ["", "a", "7", ",", "'s", "ß", "É"]]
    chunks += [f"Z{a}b{a}." for a in letters] + ["<|endoftext|>", "<|ENDOFTEXT|>", "é<|startoftext|>É", "e\u0301", "ﬁ", "İ", "ΑΣ"]
    for chunk in chunks:
        ids = library.encode(chunk, add_special_tokens=False).ids
        assert array("I", encoder.text(chunk)).tolist() == ids, chunk
    plain = packing.WordEncoder(path)
    plain.library = None
    text = "Straße, ÉLÈVE çà\net l'été's 25."
    assert array("I", plain.text(text)).tolist() == library.encode(text, add_special_tokens=False).ids


def test_ids_of_a_column_are_those_of_its_texts(monkeypatch):
    monkeypatch.setattr(packing, "STRETCH_BYTES", 40)
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [None, "", " ", "a b  c\n", "one two " * 20, "d", "", "Éa é e", "  "]
    column = pa.array(["left out", *texts], pa.string()).slice(1)
    assert list(encoder.texts(column)) == [encoder.text(t or "") for t in texts]
    assert list(encoder.texts(column.slice(0, 0))) == []


def test_known_values_are_forgotten_when_full(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_CHUNKS", 3)
    known = packing.Known(str.encode, longest=4)
    assert [known[key] for key in ("a", "b", "c", "d", "a", "long text")] == [b"a", b"b", b"c", b"d", b"a", b"long text"]
    assert set(known) == {"d", "a"}


def packed(given, capacity=64):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.best_fit(packing.token_pieces(given, path, 1, capacity), capacity).collect()


def assert_sound(rows, capacity):
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append(r)
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(r['ids'])}I", *r["ids"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences, documents


def test_packing_keeps_every_token_and_fills_sequences(spark):
    r = random.Random(2)
    rows = [(i, " ".join(f"w{r.randrange(99)}" for _ in range(r.randrange(60)))) for i in range(300)]
    found = packed(docs(spark, rows))
    sequences, documents = assert_sound(found, 64)
    library = packing.encoder(public_tokenizers.path("word_bpe_49k.json")).library
    total = 0
    for i, text in rows:
        pieces = sorted(documents[i], key=lambda p: p["piece"])
        ids = [x for p in pieces for x in p["ids"]]
        assert ids == library.encode(text, add_special_tokens=False).ids + [1]
        assert [p["start"] for p in pieces] == [64 * k for k in range(len(pieces))]
        total += len(ids)
    assert len(sequences) <= 1.05 * total / 64 + 1


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 5, 5)] == [(0, 0), (1, 0), (1, 7), (2, 0), (2, 5)]
    assert bins.put(9) == (3, 0)
    assert bins.put(8) == (4, 0)  # the bin with one place left closes
    assert bins.put(4) == (0, 6)
    with_one = packing.BestFit(10, 1)
    assert [with_one.put(n)[0] for n in (6, 5, 4)] == [0, 1, 1]


def test_packing_on_awkward_rows(spark):
    found = packed(awkward(spark))
    sequences, documents = assert_sound(found, 64)
    assert documents[2][0]["ids"] == documents[3][0]["ids"] == [1]
    assert len(documents[None]) == len(documents[1]) and len(documents[5]) == 2 * len(documents[1])
    assert packed(awkward(spark).limit(0)) == []
    assert packed(clashing(spark, [(1, "a b")]))[0]["length"] == 3


def test_language_of_held_out_documents(spark):
    from martwright.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op10_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    told = [r for r in rows if r["held_out"] and r["lang"] is not None]
    assert len(told) > 150 and sum(r["lang"] == r["lang_pred"] for r in told) >= 0.95 * len(told)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_language_on_awkward_rows(spark):
    given = docs(spark, [(i, LINE + str(i)) for i in range(30)]).withColumn("lang", F.lit("en"))
    other = docs(spark, [(99, "der schnelle braune fuchs springt über den faulen hund und rennt weg " * 9)])
    learned = language_id.learn_dictionaries(given.unionByName(other.withColumn("lang", F.lit("de"))))
    assert sorted(learned) == ["de", "en"]
    found = {r["doc_id"]: r for r in language_id.identify(awkward(spark), learned).collect()}
    assert len(found) == 9 and found[1]["lang_pred"] == "en" and not found[1]["rejected"]
    for i in (2, 3, 4, 8):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["rejected"]) == ("und", 0.0, True)
    nothing = language_id.learn_dictionaries(given.withColumn("lang", F.lit(None).cast("string")))
    assert nothing == {} and language_id.identify(given, nothing).first()["lang_pred"] == "und"
    assert language_id.identify(given.limit(0), learned).count() == 0
    alike = language_id.identify(given, {"a": b"x y z" * 9, "b": b"x y z" * 9}).first()
    assert alike["rejected"] and alike["lang_pred"] == "a"
    assert language_id.identify(clashing(spark, [(1, LINE)]), learned).first()["lang_pred"] == "en"


PAGES = "page_id long, url string, html string"


def archived(spark, rows):
    pages = spark.createDataFrame(rows, PAGES)
    return warc.read_archives(warc.write_archives(warc.plan_records(pages)))


def test_archives_round_trip_with_revisits(spark):
    big, small = "p" * 1200, "q" * 10
    rows = [(1, "http://a/1", big), (2, "u\r\nX: 1%", big), (3, None, small), (4, "http://a/4", small), (5, "http://a/5", None),
            (6, "", "é" * 600), (7, "http://a/7", "é" * 600), (7, "http://a/7", "é" * 600), (None, "n", big)]
    found = archived(spark, rows).collect()
    assert len(found) == 9
    by = {r["page_id"]: r for r in found}
    for page, url, html in rows:
        body = (html or "").encode()
        assert by[page]["url"] == url and by[page]["payload_bytes"] == len(body)
        assert by[page]["payload_digest"] == hashlib.sha1(body).hexdigest()
        if by[page]["record_type"] == "response":
            assert by[page]["payload"] == body
    assert {p: r["refers_to"] for p, r in by.items()} == {
        1: 2, 2: None, 3: None, 4: None, 5: None, 6: 7, 7: None, None: 2,
    }
    assert archived(spark, []).count() == 0


def test_damaged_archives_are_refused(spark):
    good = warc.write_archives(warc.plan_records(spark.createDataFrame([(1, "u", "x" * 50)], PAGES))).first()["content"]
    assert [h["warc-type"] for h, _ in warc.read_archive(good)] == ["response"]
    size = struct.unpack_from("<I", good, 4)[0]
    for bad in (b"", good[8:], good[:20], good[:-3], good + b"junk", good[: 8 + size] + b"junk"):
        with pytest.raises(warc.ArchiveError):
            list(warc.read_archive(bad))
    for change in ((b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: 3", b"Content-Length: 4"), (b"sha1:", b"sha1:0"), (b"WARC-Date", b"Other")):
        body = warc.record("response", {"WARC-Record-ID": "i", "WARC-Date": "d", "WARC-Payload-Digest": "sha1:" + hashlib.sha1(b"abc").hexdigest()}, b"abc")
        assert warc.parse_record(body)[1] == b"abc"
        with pytest.raises(warc.ArchiveError):
            warc.parse_record(body.replace(*change))
    packed_words = zstandard.ZstdCompressor().compress(good[8 : 8 + size])
    nested = struct.pack("<II", warc.SKIPPABLE_MAGIC, len(packed_words)) + packed_words + good[8 + size :]
    assert len(list(warc.read_archive(nested))) == 1


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def test_control_strings_are_escaped_reversibly():
    r = random.Random(1)
    parts = [*chat.CONTROL, "\\", "\n", "a", "<", "[", "s>", "/INST]", ""]
    for _ in range(2000):
        turns = [("".join(r.choices(["user", "a<s>", "\\"], k=1)), "".join(r.choices(parts, k=r.randint(0, 8)))) for _ in range(3)]
        turns[1] = ("assistant", turns[1][1])
        formatted, spans = chat.format_turns(turns)
        assert chat.read_turns(formatted) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == [turns[1][1]]


def test_trees_yield_their_best_paths(spark):
    rows = [("t", 1, None, 0.0), ("t", 2, 1, 1.0), ("t", 3, 1, 2.0), ("t", 4, 2, 5.0), ("t", 5, 3, 1.0), ("t", 6, 3, 0.0),
            ("s", 1, None, 0.0), (None, 1, None, 0.0), (None, 2, 1, 0.0)]
    rows += [("deep", i, i - 1 if i else None, 0.0) for i in range(40)]
    given = [(t, m, p, "user" if m % 2 else "assistant", f"{t}{m}", s) for t, m, p, s in rows]
    messages = spark.createDataFrame(given, "tree string, message long, parent long, role string, text string, score double")
    found = {(r["tree"], r["rank"]): r for r in chat.format_conversations(messages, 2).collect()}
    texts = lambda key: [t for _, t in chat.read_turns(found[key]["formatted"])]
    assert texts(("t", 1)) == ["t1", "t2", "t4"] and texts(("t", 2)) == ["t1", "t3", "t5"]
    assert texts(("s", 1)) == ["s1"] and texts((None, 1)) == ["None1", "None2"]
    assert texts(("deep", 1)) == [f"deep{i}" for i in range(40)]
    assert ("t", 3) not in found and ("s", 2) not in found


def test_conversations_on_awkward_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 1, None, None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 0, "user", ""),
            (2, None, "assistant", "x" * 50_000), (2, 0, "us\ner", "</s><s>")]
    given = spark.createDataFrame(rows, CONVERSATIONS).withColumn("score", F.lit("x")).withColumn("tree", F.lit(1))
    found = chat.format_conversations(chat.linear_trees(given))
    turns = {r["tree"]: chat.read_turns(r["formatted"]) for r in found.collect()}
    assert turns[1] == [("user", "a"), ("", ""), ("assistant", "b"), ("assistant", "b")]
    assert turns[None] == [("user", "")] and turns[2] == [("assistant", "x" * 50_000), ("us er", "</s><s>")]
    back = {r["conv_id"]: r for r in chat.read_back(found).collect()}
    assert back[1]["n_turns"] == 4 and back[1]["loss_chars"] == 2
    assert back[None]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert chat.format_conversations(chat.linear_trees(given.limit(0))).count() == 0
