"""Language identification by compression.

A text is compressed with one zstandard raw-content dictionary per language; the
language whose dictionary leaves the fewest bytes wins, and a narrow win is marked.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import map_batches, texts_of

DICTIONARY_ROWS = 400
DICTIONARY_BYTES = 96 * 1024
BLOCK_BYTES = 2048
LEVEL = 9
SHARPNESS = 40.0
MIN_MARGIN = 0.02
MAX_LANGUAGES = 1000
UNDETERMINED = "und"
NO_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case words alone, as marks and capitals tell little of a language."""
    return NO_LETTERS.sub(" ", text.lower())


def learn_dictionaries(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    rows: int = DICTIONARY_ROWS,
    size: int = DICTIONARY_BYTES,
) -> dict[str, bytes]:
    """Raw-content dictionary of each language from a bounded sample of its texts.

    Of every language the ``rows`` different texts that come first in order of a hash
    take part, each with an equal share of ``size`` from its middle, so that neither
    long texts nor copies fill the dictionary. Rows without a language, or with a text
    that holds no letter, teach nothing. More than ``MAX_LANGUAGES`` languages raise.
    What reaches the driver is some ``size`` bytes a language, whatever the input size.
    """
    share = max(64, size // rows)
    usable = docs.select(
        docs[lang].alias("lang"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("order")
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("order").alias("n"))
    known = {r["lang"]: r["n"] for r in counts.limit(MAX_LANGUAGES + 1).collect()}
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not known:
        return {}
    # A hash below this bound leaves some four times the rows wanted, without a sort of all.
    bounds = F.create_map(
        *(F.lit(x) for name, n in known.items() for x in (name, min(1.0, 4 * rows / max(1, n))))
    )
    low = F.shiftrightunsigned("order", 11) / float(1 << 53) <= F.element_at(bounds, F.col("lang"))
    start = F.greatest(F.lit(1), (F.length("text") / 2 - share / 2).cast("int"))
    first = Window.partitionBy("lang").orderBy("order")
    sample = (
        usable.where(low)
        .select("lang", "order", F.substring("text", start, F.lit(share)).alias("part"))
        .groupBy("lang", "order").agg(F.min("part").alias("part"))
        .withColumn("at", F.row_number().over(first))
        .where(F.col("at") <= rows)
    )
    parts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():
        parts.setdefault(row["lang"], []).append((row["at"], row["part"]))
    return {name: letters("\n".join(p for _, p in sorted(found))).encode() for name, found in sorted(parts.items())}


class Compressors:
    def __init__(self, dictionaries: tuple[tuple[str, bytes], ...]):
        import zstandard

        self.names = [name for name, _ in dictionaries]
        self.all = []
        for _, data in dictionaries:
            content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.all.append(
                zstandard.ZstdCompressor(
                    dict_data=content, write_content_size=False, write_dict_id=False
                ).compress
            )

    def classify(self, text: str) -> tuple[str, float, float]:
        """Language, score and margin; every block of the whole text is compressed."""
        if not self.names or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0
        data = letters(text).encode()
        blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = [sum(len(compress(b)) for b in blocks) for compress in self.all]
        best = min(sizes)
        at = sizes.index(best)
        others = [n for i, n in enumerate(sizes) if i != at]
        margin = (min(others) - best) / best if others else 1.0
        score = 1 / sum(math.exp(-SHARPNESS * (n - best) / best) for n in sizes)
        return self.names[at], score, margin


@lru_cache(maxsize=2)
def compressors(dictionaries: tuple[tuple[str, bytes], ...]) -> Compressors:
    return Compressors(dictionaries)


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    min_margin: float = MIN_MARGIN,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``id``, lang_pred, score, margin and rejected.

    ``lang_pred`` is the language of the smallest code, ties going to the name first in
    order; ``rejected`` marks a margin below ``min_margin`` between the two smallest.
    A null text, one without a letter, or an empty set of dictionaries gives ``und``
    with score 0, rejected. Only ``id`` and ``text`` are read; repeated rows get equal
    results.
    """
    spark = docs.sparkSession
    kind = docs.schema[id].dataType.simpleString()
    shared = spark.sparkContext.broadcast(tuple(sorted(dictionaries.items())))

    def identified(batch: pa.RecordBatch) -> pa.RecordBatch:
        classify = compressors(shared.value).classify
        found = [classify(t) for t in texts_of(batch.column(1))]
        names, scores, margins = zip(*found)
        rejected = [m < min_margin for m in margins]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                pa.array(margins, pa.float64()), pa.array(rejected, pa.bool_()),
            ],
            names=[id, "lang_pred", "score", "margin", "rejected"],
        )

    schema = f"`{id}` {kind}, lang_pred string, score double, margin double, rejected boolean"
    return map_batches(docs.select(docs[id], docs[text]), identified, schema)
