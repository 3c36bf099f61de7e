"""Awkward rows for every operator: nulls, empty and long texts, repeats, odd columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "the quick brown fox jumps over the lazy dog and runs into the deep green wood. "


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def awkward(spark):
    rows = [
        (1, LINE * 3), (2, None), (3, ""), (None, LINE * 3), (4, "  \n\t "), (5, LINE * 3),
        (5, LINE * 3), (6, "é" * 3000), (7, " ".join(f"w{i}" for i in range(20_000))), (8, "!!! ???"),
    ]
    return docs(spark, rows)


def clashing(spark, rows):
    """Documents with columns named like those that operators add or use inside."""
    from pyspark.sql import functions as F

    names = [
        "kept", "score", "id", "label", "n_words", "cleaned_text", "bucket", "start", "size", "band",
        "member", "center", "component", "order", "at", "piece", "length", "offset", "lang_pred",
    ]
    return docs(spark, rows).withColumns({name: F.lit("x") for name in names})
