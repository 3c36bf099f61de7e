"""Line-first quality rules, built from DataFrame functions only.

Every line is judged by punctuation, navigation and boilerplate rules. Lines that
fail are removed, and a document that loses too much of its text is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SHORT_LINE = 80
MIN_SEPARATORS = 3
MAX_LOST_PERCENT = 50

TERMINAL = r"""[.!?:;…"'”’»)\]][\x20\x09-\x0D]*\z"""
SEPARATORS = (" | ", " > ", " » ", " • ")
BOILERPLATE = (
    "all rights reserved",
    "privacy policy",
    "terms of use",
    "enable javascript",
    "licensed under",
    "copyright (c)",
    "lorem ipsum",
    "click here",
)
POSITION_BITS = 31


def occurrences(text: Column, part: str) -> Column:
    """How often ``part`` stands in a text, from left to right, without overlaps."""
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | text.contains(part)
    return found


def line_fails(line: Column, has: dict[str, Column]) -> Column:
    """Whether a line fails a rule.

    Punctuation: a short line without an ending mark, shouting, or more than a tenth
    symbols. Navigation: three separators or more, one in forty characters.
    Boilerplate: one of the phrases. ``has`` tells which marks stand anywhere in the
    document, so that a rule without any is not looked at line by line.
    """
    size = F.length(line)
    unended = (size < SHORT_LINE) & ~line.rlike(TERMINAL)
    shouting = has["shouts"] & (occurrences(line, "!!") * 40 > size)
    plain = F.length(F.translate(line, SYMBOLS + "{}", ""))
    littered = has["symbols"] & ((size - plain) * 10 > size)
    links = sum((occurrences(line, part) for part in SEPARATORS), F.lit(0.0))
    navigation = has["links"] & (links >= MIN_SEPARATORS) & (links * 40 > size)
    boilerplate = has["phrases"] & any_of(F.lower(line), BOILERPLATE)
    return unended | shouting | littered | navigation | boilerplate


def _same(a: Column, b: Column) -> Column:
    """Equal hashes in two keys; null where there is no second one."""
    return a.bitwiseXOR(b) < (1 << POSITION_BITS)


def _position(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with counts per document, a verdict, and the text without failing lines.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``lines_removed``, ``kept`` and
    ``cleaned_text``; columns of these names in ``docs`` are replaced. ``kept`` is
    false for documents that fail the base counts or lose more than half of their
    characters with the failing lines.

    A null text has no words: it fails, and its cleaned text is empty. Lines
    without a word are neither judged nor counted, and stay. Rows are independent
    of each other, so repeated rows get equal results.
    """
    added = {
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "lines_removed", "kept", "cleaned_text",
    }
    own = {f"_own{i}": name for i, name in enumerate(docs.columns) if name not in added}
    rows = docs.select(
        *(docs[name].alias(held) for held, name in own.items()),
        F.coalesce(docs[text], F.lit("")).alias("_t"),
    )

    split = rows.select(
        *own,
        F.array_remove(F.split("_t", SPACES + "+"), "").alias("_words"),
        F.split("_t", "\n").alias("_lines"),
        F.when(
            F.col("_t").rlike(f"[{SYMBOLS}]"),
            F.length("_t") - F.length(F.translate("_t", SYMBOLS, "")),
        ).otherwise(0).alias("_symbols"),
        F.col("_t").contains("!!").alias("_shouts"),
        any_of(F.col("_t"), ("{", "}")).alias("_braces"),
        any_of(F.col("_t"), SEPARATORS).alias("_links"),
        any_of(F.lower("_t"), BOILERPLATE).alias("_phrases"),
    )
    words, size = F.col("_words"), F.size("_words")
    starts = F.greatest(F.lit(0), size - 2)
    has = {
        "shouts": F.col("_shouts"),
        "symbols": (F.col("_symbols") > 0) | F.col("_braces"),
        "links": F.col("_links"),
        "phrases": F.col("_phrases"),
    }

    def key(word: Column, at: Column) -> Column:
        """Hash of the window at a position, with the position in the low bits."""
        hashed = F.xxhash64(word, F.get(words, at + 1), F.get(words, at + 2))
        high = F.lit((1 << 63) - (1 << POSITION_BITS))
        return hashed.bitwiseAND(high).bitwiseOR(at.cast("long"))

    judged = split.select(
        *own, "_words", "_symbols", "_lines",
        F.filter("_lines", lambda line: line.rlike(WORD)).alias("_full"),
        F.filter("_lines", lambda line: ~line.rlike(WORD) | ~line_fails(line, has)).alias("_good"),
        F.length(F.array_join("_words", "")).alias("_chars"),
        F.sort_array(F.transform(F.slice("_words", F.lit(1), starts), key)).alias("_keys"),
    )
    keys, flagged = F.col("_keys"), F.col("_flagged")
    paired = judged.withColumn(
        "_flagged",
        F.filter(
            "_keys", lambda x, k: _same(x, F.get(keys, k - 1)) | _same(x, F.get(keys, k + 1))
        ),
    )

    def collides(x: Column, k: Column) -> Column:
        """Equal hash as the next one, yet other words."""
        following = F.get(flagged, k + 1)
        a, b = _position(x), _position(following)
        differs = F.lit(False)
        for j in range(3):
            differs = differs | (F.get(words, a + j) != F.get(words, b + j))
        return _same(x, following) & differs

    ordered = F.col("_sorted")

    def repeated(item: Column, k: Column) -> Column:
        before = F.get(ordered, k - 1)["text"] == item["text"]
        after = F.get(ordered, k + 1)["text"] == item["text"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    # Only documents in which two different windows share a hash sort the texts themselves.
    spelled = F.transform(
        F.slice("_words", F.lit(1), starts),
        lambda word, i: F.struct(
            F.concat_ws(" ", word, F.get(words, i + 1), F.get(words, i + 2)).alias("text"),
            i.alias("at"),
        ),
    )
    checked = paired.withColumn(
        "_sorted",
        F.when(F.size(F.filter("_flagged", collides)) > 0, F.sort_array(spelled)),
    )
    found = F.when(ordered.isNull(), F.transform("_flagged", _position)).otherwise(
        F.transform(F.filter("_sorted", repeated), lambda x: x["at"])
    )
    placed = checked.select(
        *own, "_chars", "_symbols", "_lines", "_full", "_good", size.alias("_n"),
        F.sort_array(found).alias("_at"),
    )

    def fresh(at: Column, k: Column) -> Column:
        following = F.coalesce(F.get(F.col("_at"), k + 1) - at, F.lit(3))
        return F.least(F.lit(3), following)

    add = lambda total, x: total + x
    chars = lambda lines: F.aggregate(
        lines, F.lit(0), lambda total, line: total + F.length(line)
    )
    counted = placed.select(
        *own,
        F.col("_n").cast("long").alias("n_words"),
        F.col("_chars").cast("long").alias("word_chars"),
        F.col("_symbols").cast("long").alias("n_symbols"),
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        F.aggregate(F.transform("_at", fresh), F.lit(0), add).cast("long").alias("n_repeat_words"),
        (F.size("_lines") - F.size("_good")).cast("long").alias("lines_removed"),
        chars("_lines").alias("_all_chars"),
        chars("_good").alias("_good_chars"),
        F.array_join("_good", "\n").alias("cleaned_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    )
    lost = F.col("_all_chars") - F.col("_good_chars")
    # Always true, but not for Spark to know: a filter on the verdict would else move below
    # the steps above, and each step be computed anew for every word that needs it.
    here = F.monotonically_increasing_id() >= 0
    return counted.select(
        *(F.col(held).alias(name) for held, name in own.items()),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        "lines_removed",
        (here & ~failed & (lost * 100 <= F.col("_all_chars") * MAX_LOST_PERCENT)).alias("kept"),
        "cleaned_text",
    )
