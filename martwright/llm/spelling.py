"""Spelling variants: words one edit apart, and the form that each variant stands for.

Two words are one edit apart exactly if their common prefix and common suffix together
reach the longer length minus one. One of both then reaches half of that, so such words
share their first or their last letters. Words that share them are laid out as padded
matrices of code points, block against block, and compared densely; a large group is
dealt to many tasks as pairs of blocks. Only what a word gains from a pair of blocks
leaves it: how many neighbours, and the best of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import record_batch, small_batches, stored, texts_of

MIN_LENGTH = 6
MIN_COUNT = 5
#: A form is at least so many times as frequent as its variant.
FORM_RATIO = 5
#: Words of a block; two blocks are compared at once.
BLOCK_WORDS = 2048
#: Different words that a task counts before it passes the counts on.
HELD_WORDS = 300_000
TYPO_ODDS = 199

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _typed(word: str, crc: int) -> str:
    """The word as it counts: without one letter where the odds divide its checksum."""
    checksum = zlib.crc32(word.encode(), crc)
    if checksum % TYPO_ODDS:
        return word
    at = checksum % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of all words of ``MIN_LENGTH`` letters found ``MIN_COUNT`` times or more."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, int] = defaultdict(int)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                crc = zlib.crc32(f"{'' if name is None else name}:".encode())
                for run, times in Counter(_RUN.findall(body.encode().translate(_LOWER).decode())).items():
                    if len(run) >= MIN_LENGTH:
                        held[_typed(run, crc)] += times
            if len(held) >= HELD_WORDS:
                yield record_batch({"word": list(held), "n": list(held.values())}, schema)
                held.clear()
        if held:
            yield record_batch({"word": list(held), "n": list(held.values())}, schema)

    parts = docs.select(docs[id].cast("string"), docs[text]).mapInArrow(count, "word string, n long")
    long = parts.where(F.length("word") >= MIN_LENGTH)
    return long.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def _keyed(words: DataFrame) -> DataFrame:
    """Every word under the letters that it shares with a neighbour of its length or one more."""
    length = F.length("word")
    keys = []
    for longer in (length, length + 1):
        half = F.floor(longer / 2).cast("int")  # half of longer - 1, rounded up
        for side, piece in ((0, F.substr("word", F.lit(1), half)), (1, F.substr("word", length - half + 1, half))):
            keys.append(F.struct(longer.alias("longer"), F.lit(side).alias("side"), piece.alias("piece")))
    return words.select("word", "n", F.explode(F.array(*keys)).alias("key"))


def _tiles(words: DataFrame) -> DataFrame:
    """Words by pair of blocks of their group. Groups of one word are left out."""
    keyed = _keyed(words)
    groups = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK_WORDS)
    dealt = keyed.join(groups, "key").select(
        "key", "word", "n", blocks.alias("blocks"), F.pmod(F.xxhash64("word"), blocks).alias("block")
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return dealt.select("*", other.alias("other")).select(
        "key.longer", "key.side", "key.piece", "word", "n", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )


def _matrix(words: list[str], width: int, right: bool, pad: int) -> np.ndarray:
    """Code points, all below 256, one word a row; the padding equals no letter."""
    fill = chr(pad)
    rows = [w.rjust(width, fill) if right else w.ljust(width, fill) for w in words]
    return np.frombuffer("".join(rows).encode("latin-1"), np.uint8).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading columns each row of ``a`` shares with each row of ``b``."""
    alike = np.ones((len(a), len(b)), bool)
    length = np.zeros((len(a), len(b)), np.uint8 if a.shape[1] < 256 else np.int32)
    for left, right in zip(a.T, b.T):
        alike &= left[:, None] == right[None, :]
        if not alike.any():
            break
        length += alike
    return length


def neighbours(left: list[str], right: list[str], longer: int, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the words one edit apart whose longer one has ``longer`` letters.

    ``side`` tells what the words of the group share; what the other side's group finds
    as well is left to the side of the prefix.
    """
    prefix = _common(_matrix(left, longer, False, 0), _matrix(right, longer, False, 1))
    suffix = _common(_matrix(left, longer, True, 0)[:, ::-1], _matrix(right, longer, True, 1)[:, ::-1])
    near = prefix.astype(np.int32) + suffix >= longer - 1
    sizes = np.array([len(w) for w in left]), np.array([len(w) for w in right])
    near &= np.maximum(sizes[0][:, None], sizes[1][None, :]) == longer
    if side:
        near &= prefix < longer // 2
    return np.nonzero(near)


def _gains(words: list[str], counts: np.ndarray, low: np.ndarray, longer: int, side: int, same: bool) -> dict:
    """Per word of a pair of blocks: its neighbours there, and the best of them."""
    order = sorted(range(len(words)), key=words.__getitem__)
    words, counts, low = [words[i] for i in order], counts[order], low[order]
    inside = np.flatnonzero(low), np.flatnonzero(low if same else ~low)
    a, b = neighbours([words[i] for i in inside[0]], [words[i] for i in inside[1]], longer, side)
    a, b = inside[0][a], inside[1][b]
    if same:
        a, b = a[a != b], b[a != b]
    else:
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
    by = np.lexsort((b, -counts[b], a))
    a, b = a[by], b[by]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
    return {
        "word": [words[i] for i in a[first]], "n_near": np.diff(np.append(first, len(a))),
        "form": [words[i] for i in b[first]], "form_n": counts[b[first]],
    }


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and the best neighbour ``form`` with its ``form_n``, by pair of blocks."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])
    names = ["longer", "side", "piece", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def gains() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            block = table["block"].to_numpy()
            found = _gains(
                table["word"].to_pylist(), table["n"].to_numpy(), block == key[3], key[0], key[1], key[3] == key[4]
            )
            return record_batch(found, schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(name).to_pylist() for name in names)))
            starts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, end in zip(starts, starts[1:]):
                if keys[start] != key:
                    if held:
                        yield gains()
                    key, held = keys[start], []
                held.append(batch.slice(start, end - start))
        if held:
            yield gains()

    # A pair of blocks is one group of at most some two blocks of words, whole in one partition.
    sorted_tiles = _tiles(words).repartition(*names).sortWithinPartitions(*names)
    return sorted_tiles.mapInArrow(compare, "word string, n_near long, form string, form_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and the last form of its chain. Every join doubles the steps followed.

    A form is ``FORM_RATIO`` times as frequent as its word, so a chain is no longer than
    the logarithm of the largest count, and never closes.
    """
    while True:
        further = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(forms.join(further, "root", "left").select("word", "root", "next"), "roots")
        if joined.where("next is not null").isEmpty():
            return joined.select("word", "root")
        forms = joined.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every counted word.

    Only ``id`` and ``text`` are read, other columns may have any name. A null text has
    no words, a null id counts as an empty one. Repeated rows count each time. Of equally
    frequent neighbours the smallest in code-point order is the form. Texts and words may
    have any length; an empty table gives no rows.
    """
    words = stored(word_counts(docs, id, text), "words")
    gains = near_words(words)
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form"))).alias("best")
    near = stored(gains.groupBy("word").agg(F.sum("n_near").alias("n_near"), best), "near")
    enough = -F.col("best.minus") >= FORM_RATIO * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    judged = stored(judged, "judged")
    roots = _roots(judged.where("form is not null").select("word", F.col("form").alias("root")))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
