import zlib

import pytest
from pyspark.sql import functions as F

from martwright.llm import quality_classifier, quality_rules
from martwright.llm.quality_rules import quality_rules as rules
from tests.llm.helpers import LINE, awkward, clashing, docs


def brute_repeats(text):
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(covered)


TEXTS = [
    "a b c a b c d", "a a a a a", "x", "", "a b c\nb c a\na b c", LINE * 4,
    "one two three. one two three, one two three.", "a b a b a b a",
]


def test_repeated_words_equal_brute_force(spark):
    found = rules(docs(spark, enumerate(TEXTS))).select("doc_id", "n_repeat_words").collect()
    assert {r[0]: r[1] for r in found} == {i: brute_repeats(t) for i, t in enumerate(TEXTS)}


def test_equal_hashes_of_different_windows_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "POSITION_BITS", 62)
    test_repeated_words_equal_brute_force(spark)


def test_lines_fail_by_rule_and_documents_by_loss(spark):
    good = LINE.strip()
    lines = {
        "home | about | news | contact.": True, "Read more": True, "WOW!! NOW!! YES!!": True,
        "### *** %%%.": True, good: False, "All rights reserved by the owners of this page.": True,
        "A fine short line.": False,
    }
    rows = [(i, f"{(good + chr(10)) * 6}{line}") for i, line in enumerate(lines)]
    found = {r["doc_id"]: r for r in rules(docs(spark, rows)).collect()}
    for i, (line, fails) in enumerate(lines.items()):
        assert found[i]["lines_removed"] == fails
        assert (line in found[i]["cleaned_text"].split("\n")) != fails
    lost = rules(docs(spark, [(1, good + "\n" + "\n".join(["menu | a | b | c | d"] * 30))])).first()
    assert not lost["kept"] and lost["lines_removed"] == 30


def test_rules_on_awkward_rows(spark):
    found = rules(awkward(spark)).orderBy("doc_id").collect()
    assert len(found) == 10
    empty = [r for r in found if r["doc_id"] in (2, 3)]
    assert all(r["n_words"] == 0 and r["base_failed"] and not r["kept"] for r in empty)
    assert next(r for r in found if r["doc_id"] == 7)["n_words"] == 20_000
    assert rules(awkward(spark).limit(0)).count() == 0
    odd = rules(clashing(spark, [(1, LINE)]))
    assert odd.first()["kept"] in (True, False) and odd.first()["band"] == "x"


def test_a_filter_on_the_verdict_stays_above_the_counts(spark):
    plan = rules(awkward(spark)).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Filter (isnotnull(kept#")


def training(spark):
    good = [(i, f"{LINE} number {i} of them. " * 3, 1) for i in range(120)]
    bad = [(1000 + i, "BUY!! NOW!! " * (5 + i % 9), 0) for i in range(60)]
    rows = docs(spark, [(i, t) for i, t, _ in good + bad])
    return rows, spark.createDataFrame([(i, q, 0) for i, _, q in good + bad], "doc_id long, quality int, toxic int")


def test_classifier_separates_and_calibrates(spark):
    rows, labels = training(spark)
    model = quality_classifier.fit(rows, labels, "quality")
    found = {r["doc_id"]: r["score"] for r in quality_classifier.score(rows, model).collect()}
    assert min(found[i] for i in range(120)) > 0.5 > max(found[1000 + i] for i in range(60))
    again = quality_classifier.fit(rows.repartition(3), labels, "quality")
    assert found[7] == pytest.approx(quality_classifier.score(rows, again).where("doc_id = 7").first()["score"])


def test_held_out_accuracy_on_given_tables(spark):
    from martwright.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    found = QUERIES["op2_quality_classifier"](spark, sf)
    joined = found.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(joined) > 50
    assert sum(r["predicted"] == r["quality"] for r in joined) >= 0.93 * len(joined)
    for row in found.collect():
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) and 0 <= row["score"] <= 1


def test_classifier_on_awkward_rows(spark):
    rows, labels = training(spark)
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0), (2, 0, 0)], labels.schema))
    model = quality_classifier.fit(rows, odd, "quality")
    assert quality_classifier.score(awkward(spark), model).where(F.col("score").between(0, 1)).count() == 10
    blank = quality_classifier.fit(rows.limit(0), labels.limit(0), "quality")
    assert quality_classifier.score(rows.limit(3), blank).select("score").distinct().collect() == [(0.5,)]
    assert quality_classifier.score(rows.limit(0), model).count() == 0
    assert quality_classifier.score(clashing(spark, [(1, "a b")]), model).columns == ["doc_id", "score"]
