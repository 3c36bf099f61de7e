import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from martwright.llm import decontaminate, minhash
from tests.llm.helpers import DOCS
from tests.llm.test_duplicates import brute_components, brute_removed

ITEM = "Which of these rivers flows through the old town before it meets the sea near the harbour?"


def text_of(i, extra=""):
    lines = (f"L{k}x{i} o{k * 3}x{i} tells about w{i * 31 + k}, w{i * 17 + k * 3} and v{i * 40 + k} too{extra}." for k in range(12))
    return "\n".join(lines)


def given(spark):
    rows = [(i, text_of(i)) for i in range(20)]
    rows += [(100, text_of(3)), (101, text_of(4) + "\nOne more line stands at the end of it."), (102, text_of(5) + "\n" + ITEM)]
    rows += [(103, text_of(50) + "\n" + ITEM), (104, "short"), (105, None), (106, "\n".join(["a | b | c | d"] * 40))]
    rows += [(107, text_of(60) + "\n" + text_of(7)[:300] + "."), (108, text_of(70) + "\nhome | a | b | c"), (None, text_of(80)), (8, text_of(8))]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def test_stages_equal_brute_force(spark, tmp_path):
    docs = given(spark)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "near-duplicates", "repeated passages", "benchmark leaks", "packing"]

    clean = stages["quality rules"](spark, docs, sf)
    rows = {(r["doc_id"], r["text"]) for r in clean.collect()}
    assert {i for i, _ in rows} == {r["doc_id"] for r in docs.collect()} - {104, 105, 106}
    assert (108, text_of(70)) in rows
    assert all(r["n_chars"] == len(r["text"]) for r in clean.collect()) and clean.columns == docs.columns

    single = stages["near-duplicates"](spark, clean, sf)
    group, _ = brute_components([(i, t) for i, t in rows if i is not None])
    left = [(r["doc_id"], r["text"]) for r in single.collect()]
    assert sorted(i for i, _ in left if i is not None) == sorted({i for i, g in group.items() if i == g})
    assert None in {i for i, _ in left} and single.columns == docs.columns

    cut = stages["repeated passages"](spark, single, sf)
    want = brute_removed([(i, t.encode()) for i, t in left if i is not None])
    for r in cut.where("doc_id is not null").collect():
        assert r["text"] == want[r["doc_id"]][0].decode("utf-8", "ignore")

    pure = stages["benchmark leaks"](spark, cut, sf)
    normal = decontaminate.normal(ITEM)
    kept = {r["doc_id"] for r in pure.collect()}
    assert kept == {r["doc_id"] for r in cut.collect() if normal not in decontaminate.normal(r["text"])}
    assert 103 not in kept or 102 not in kept

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids + [1] for r in pure.collect()}
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"]: r["ids"] for r in packed} == ids
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)


def test_different_texts_under_one_id_are_different_documents(spark):
    near = text_of(1).replace("tells", "says", 1)
    rows = [(1, near), (5, text_of(1)), (5, text_of(2)), (5, text_of(2)), (6, text_of(2)), (7, text_of(3)), (7, text_of(3) + " "), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert {(i, c, k) for i, _, c, k in found} == {(1, 1, True), (5, 1, False), (5, 5, True), (6, 5, False), (7, 7, True), (8, 8, True)}
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [(1, near), (5, text_of(2)), (7, text_of(3)), (8, "")]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    given(spark).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
