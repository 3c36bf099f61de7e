"""Phrases whose words keep company, by language.

Three steps over all texts:

1. Texts are tokenised once into chunks: a vocabulary and a stream of word numbers.
2. Every chunk sends the counts of its n-grams, as hashes, to hash partitions (slices).
   Each slice merges these summaries into a Misra-Gries summary whose capacity exceeds
   its mass divided by the threshold, so no n-gram that reaches the threshold is lost.
3. Chunks count those survivors again, exactly and by their words; what does not reach
   the threshold after all leaves. Scores are joins between the counts of parts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import record_batch, small_batches, stored, texts_of

MAX_WORDS = 3
#: Words of a chunk: what a Python worker holds at once, some 100 bytes for each.
CHUNK_WORDS = 1 << 20
#: Text that one hash partition of n-grams stands for.
SLICE_BYTES = 8 << 20
MAX_SLICE_BITS = 24
#: Bits of a hash in a summary. Equal hashes share a counter, so one survives too many.
KEY_BITS = 48
KEY_BYTES = KEY_BITS // 8
#: Parts that the candidates of a language are ranked in before they meet.
RANK_PARTS = 256
UNDETERMINED = "und"

_DELIMITERS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"."
_TABLE = bytes(
    _BREAK[0] if b in _DELIMITERS else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = pa.schema(
    [("chunk", pa.string()), ("lang", pa.string()), ("n", pa.int64()), ("starts", pa.int32()),
     ("words", pa.binary()), ("stream", pa.binary())]
)


def split_words(text: str) -> list[bytes]:
    """Lower-cased words of a text as UTF-8, with a dot wherever a piece ends.

    Every delimiter and capital is a single byte, and no byte of a longer character can
    be taken for one, so the whole text is translated byte by byte.
    """
    return text.encode().translate(_TABLE).replace(_BREAK, b" . ").split()


# -- 1. chunks -------------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _chunk_rows(lang: str, vocabulary: list[bytes], stream: np.ndarray) -> Iterator[dict]:
    """Pieces of a stream of word numbers (-1 where a piece of text ends).

    Each piece of ``CHUNK_WORDS`` places carries the next two besides, so that an n-gram
    across its end is seen; only n-grams from its first ``starts`` places are its own.
    """
    for at in range(0, len(stream), CHUNK_WORDS):
        part = stream[at : at + CHUNK_WORDS + MAX_WORDS - 1]
        starts = min(CHUNK_WORDS, len(stream) - at)
        used, numbers = np.unique(part, return_inverse=True)
        if used[0] == -1:
            used, numbers = used[1:], numbers - 1
        if not len(used):
            continue
        words = b" ".join([vocabulary[u] for u in used])
        yield {
            "lang": lang, "n": int(np.count_nonzero(part[:starts] >= 0)), "starts": starts,
            "words": zstandard.ZstdCompressor(level=1).compress(words),
            "stream": _packed(numbers.astype(np.int32)),
        }


def chunked(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per chunk of the words of one language.

    A null text is empty, a null language ``und``. A text of any length is cut between
    chunks at any word, without loss of the n-grams across the cut.
    """
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, size = TaskContext.get().partitionId(), 0, 0
        numbers: dict[str, defaultdict] = {}
        streams: dict[str, list[np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made
            for name, parts in streams.items():
                for row in _chunk_rows(name, list(numbers[name]), np.concatenate(parts)):
                    yield record_batch({k: [v] for k, v in row.items()} | {"chunk": [f"{task}-{made}"]}, _CHUNK)
                    made += 1
            numbers.clear()
            streams.clear()

        for batch in batches:
            for body, name in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                words = split_words(body)
                if not words:
                    continue
                name = UNDETERMINED if name is None else name
                known = numbers.get(name)
                if known is None:
                    known = numbers[name] = defaultdict()
                    known.default_factory = known.__len__
                    known[_BREAK], streams[name] = -1, []
                # The dot is -1 and first in the dictionary, so a word's number is its place there.
                streams[name] += [
                    np.fromiter(map(known.__getitem__, words), np.int32, len(words)), np.array([-1], np.int32)
                ]
                size += len(words)
                if size >= CHUNK_WORDS:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.select(docs[text], docs[lang].cast("string")).mapInArrow(
        cut, "chunk string, lang string, n long, starts int, words binary, stream binary"
    )


# -- 2. survivors ----------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _places(stream: np.ndarray, starts: int) -> list[np.ndarray]:
    """Places where an n-gram of one, two and three words starts inside a piece of text."""
    word = stream >= 0
    found, open_ = [], word
    for size in range(1, MAX_WORDS + 1):
        if size > 1:
            open_ = open_[:-1] & word[size - 1 :]
        found.append(np.flatnonzero(open_[:starts]))
    return found


def _hashed(lang: str, words: list[bytes], stream: np.ndarray, places: list[np.ndarray]) -> list[np.ndarray]:
    """Hash of ``KEY_BITS`` bits of each n-gram, in order of ``places``."""
    prefix = lang.encode() + b" "
    own = np.array([xxhash.xxh3_64_intdigest(prefix + w) for w in words], np.uint64)
    own = np.append(own, np.uint64(0))[stream]
    run, out = own, []
    for size, at in enumerate(places):
        if size:
            run = _mixed(run[:-1] * _MIX + own[size:])
        out.append(_mixed(run[at] + np.uint64(size)) >> np.uint64(64 - KEY_BITS))
    return out


def _encoded(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane: the high planes are empty."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].T).tobytes()
    )


def _decoded(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(KEY_BYTES, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :KEY_BYTES] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary that other summaries are merged into.

    Whenever more than ``capacity`` counters are left, the largest one too many is taken
    off all. Each such cut removes at least ``capacity + 1`` times its size of the mass,
    so a counter is short by less than mass / capacity at the end.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity, self.cut = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._held = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._held += len(keys)
        if self._held > self.capacity:
            self.settle()

    def settle(self) -> None:
        parts = [(self.keys, self.counts), *self._waiting]
        self._waiting, self._held = [], 0
        keys, counts = _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        if len(keys) > self.capacity:
            over = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.cut += over
            left = counts > over
            keys, counts = keys[left], counts[left] - over
        self.keys, self.counts = keys, counts

    def reaching(self, threshold: int) -> np.ndarray:
        """Sorted keys that may have reached ``threshold``; every key that did is among them."""
        self.settle()
        return self.keys[self.counts + self.cut >= threshold]


def _slice_bits(spark_bytes: int) -> int:
    return min(MAX_SLICE_BITS, max(3, (max(1, spark_bytes) // SLICE_BYTES).bit_length()))


def _summaries(chunks: DataFrame, bits: int) -> DataFrame:
    """``slice``, ``chunk``, ``mass`` and the counters of each chunk, by hash partition.

    An empty slice sends nothing, so there are never more rows than different n-grams.
    """
    schema = pa.schema(
        [("slice", pa.int32()), ("chunk", pa.string()), ("mass", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                words, stream = _opened(row)
                keys = np.concatenate(_hashed(row["lang"], words, stream, _places(stream, row["starts"])))
                keys, counts = np.unique(keys, return_counts=True)
                ends = np.searchsorted(keys >> np.uint64(KEY_BITS - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                out: dict[str, list] = {name: [] for name in schema.names}
                for part in np.flatnonzero(np.diff(ends)):
                    inside = slice(ends[part], ends[part + 1])
                    out["slice"].append(int(part))
                    out["mass"].append(int(counts[inside].sum()))
                    out["keys"].append(_encoded(keys[inside]))
                    out["counts"].append(_packed(counts[inside].astype(np.int32)))
                out["chunk"] = [row["chunk"]] * len(out["slice"])
                yield record_batch(out, schema)

    return chunks.select("chunk", "lang", "starts", "words", "stream").mapInArrow(
        count, "slice int, chunk string, mass long, keys binary, counts binary"
    )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows one by one, as a chunk is large."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


def _opened(row: dict) -> tuple[list[bytes], np.ndarray]:
    words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b" ")
    return words, _unpacked(row["stream"], np.int32)


def survivors(summaries: DataFrame, threshold: int) -> DataFrame:
    """``chunk`` and the keys among its own that may reach ``threshold`` over all chunks.

    A slice stands for ``SLICE_BYTES`` of text whatever the corpus: a hot n-gram is one
    counter of each chunk.
    """
    schema = pa.schema([("chunk", pa.string()), ("slice", pa.int32()), ("keys", pa.binary())])

    def merged(table: pa.Table) -> pa.Table:
        mass = sum(table["mass"].to_pylist())
        summary = Summary(mass // threshold + 1)
        rows = list(zip(table["chunk"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist()))
        for _, keys, counts in rows:
            summary.merge(_decoded(keys), _unpacked(counts, np.int32).astype(np.int64))
        reached = summary.reaching(threshold)
        found = [(chunk, np.intersect1d(_decoded(keys), reached, assume_unique=True)) for chunk, keys, _ in rows]
        found = [(chunk, keys) for chunk, keys in found if len(keys)]
        number = table["slice"][0].as_py()
        return pa.Table.from_batches(
            [record_batch(
                {"chunk": [c for c, _ in found], "slice": [number] * len(found), "keys": [_encoded(k) for _, k in found]}, schema
            )], schema
        )

    return summaries.groupBy("slice").applyInArrow(merged, "chunk string, slice int, keys binary")


# -- 3. exact counts -------------------------------------------------------------------


def _exact(chunks: DataFrame) -> DataFrame:
    """Counts of the surviving n-grams of each chunk, by their words."""
    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("count", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                words, stream = _opened(row)
                parts = sorted(row["parts"], key=lambda p: p["slice"])
                kept = np.concatenate([_decoded(p["keys"]) for p in parts])
                names = [w.decode() for w in words]
                width = np.int64(len(words))
                places = _places(stream, row["starts"])
                for size, (at, keys) in enumerate(zip(places, _hashed(row["lang"], words, stream, places)), 1):
                    near = np.minimum(np.searchsorted(kept, keys), len(kept) - 1)
                    at = at[kept[near] == keys]
                    if not len(at):
                        continue
                    # Numbers of the n-grams: exact, as they tell the words of this chunk.
                    gram = stream[at].astype(np.int64)
                    columns = [gram]
                    for step in range(1, size):
                        seen, gram = np.unique(gram, return_inverse=True)
                        nxt = stream[at + step].astype(np.int64)
                        columns.append(nxt)
                        gram = gram * width + nxt
                    _, first, counts = np.unique(gram, return_index=True, return_counts=True)
                    phrases = [names[i] for i in columns[0][first]]
                    for column in columns[1:]:
                        phrases = [f"{p} {names[i]}" for p, i in zip(phrases, column[first])]
                    yield record_batch(
                        {"lang": [row["lang"]] * len(first), "size": [size] * len(first), "phrase": phrases, "count": counts}, schema
                    )

    return chunks.select("lang", "starts", "words", "stream", "parts").mapInArrow(
        count, "lang string, size int, phrase string, count long"
    )


def frequent_phrases(chunks: DataFrame, threshold: int) -> DataFrame:
    """``lang``, ``size``, ``phrase`` and ``f`` of all n-grams found ``threshold`` times or more."""
    size = chunks.agg(F.sum(F.length("words") + F.length("stream"))).first()[0] or 0
    # Compressed streams take about a third of the text.
    summaries = _summaries(chunks, _slice_bits(3 * size))
    replies = stored(survivors(summaries, threshold), "survivors")
    by_chunk = replies.groupBy("chunk").agg(F.collect_list(F.struct("slice", "keys")).alias("parts"))
    counted = _exact(chunks.join(by_chunk, "chunk"))
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("count").alias("f")).where(F.col("f") >= threshold)


def _scored(grams: DataFrame) -> DataFrame:
    """Phrases of two and three words with their lowest-scoring cut."""
    words = F.split("phrase", " ")
    first = F.element_at(words, 1)
    rest = F.array_join(F.slice(words, 2, MAX_WORDS), " ")
    head = F.array_join(F.slice(words, 1, 2), " ")
    last = F.element_at(words, 3)
    phrases = grams.where("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), first.alias("p1"), rest.alias("q1"),
        F.when(F.col("size") > 2, head).alias("p2"), F.when(F.col("size") > 2, last).alias("q2"),
    )
    for part in ("p1", "q1", "p2", "q2"):
        counts = grams.select("lang", F.col("phrase").alias(part), F.col("f").alias(f"f_{part}"))
        phrases = phrases.join(counts, ["lang", part], "left")
    # Counts of up to 15 digits: a product of two and a million has at most 37.
    wide = {name: F.col(name).cast("decimal(15,0)") for name in ("a", "f_p1", "f_q1", "f_p2", "f_q2")}
    phrases = phrases.withColumns({f"{name}_": column for name, column in wide.items()})
    cuts = [
        F.struct(
            F.expr(f"(a_ * a_ * CAST(1000000 AS DECIMAL(7,0))) div (f_p{k}_ * f_q{k}_)").alias("score"),
            F.lit(k).alias("k"), F.col(f"f_p{k}").alias("l"), F.col(f"f_q{k}").alias("r"),
        )
        for k in (1, 2)
    ]
    # A struct is smaller by its score, then by its place.
    best = F.when(F.col("size") > 2, F.least(*cuts)).otherwise(cuts[0])
    return phrases.withColumn("best", best).select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score")


def _without_parts(scored: DataFrame, percent: int) -> DataFrame:
    """Phrases that do not mostly stand inside one longer phrase."""
    words = F.split("phrase", " ")
    inner = F.explode(F.array(*(F.array_join(F.slice(words, k, 2), " ") for k in (1, 2))))
    covers = (
        scored.where("size = 3").select("lang", inner.alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
        .withColumn("size", F.lit(2))
    )
    joined = scored.join(covers, ["lang", "phrase", "size"], "left")
    return joined.where(F.coalesce(F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a"), F.lit(True))).drop("longer")


def collocations(
    docs: DataFrame, top: int = 2000, threshold: int = 10, percent: int = 50, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The ``top`` phrases of each language by the score of their weakest cut.

    ``docs`` may have any other columns; only ``text`` and ``lang`` are read. A null text
    is empty, a null language ``und``. Repeated rows count each time. Ties are ranked by
    frequency, then by the phrase in byte order. A language without a phrase found
    ``threshold`` times has no row; an empty table gives none. Texts may have any length.
    """
    chunks = stored(chunked(docs, text, lang), "chunks")
    totals = chunks.groupBy("lang").agg(F.sum("n").alias("n"))
    grams = stored(frequent_phrases(chunks, threshold), "grams")
    kept = _without_parts(_scored(grams), percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: each part names its own first, then these meet.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    firsts = (
        kept.withColumn("part", part)
        .withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
        .where(F.col("place") <= top)
    )
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
