"""Packing of tokenised documents into sequences of fixed length.

Documents are encoded where they are read, cut into pieces only when longer than a
sequence, and packed by bounded-space online best fit: a fixed number of open bins,
found by their free space in a bitset. When all are open, the fullest closes first.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import map_batches, small_batches, stored

CAPACITY = 4096
OPEN_BINS = 256
PIECES_PER_TASK = 200_000
#: Chunks and words whose ids a worker keeps.
KEPT_CHUNKS = 800_000
#: Text whose chunks are looked up together.
STRETCH_BYTES = 4 << 20

#: Chunks whose letters have one spelling each: composed, and lower-cased one by one.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """What a byte-level vocabulary writes for letters beyond ASCII: one letter for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    letters = {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(others)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class Known(dict):
    """Values by key, worked out when first asked for; emptied when full."""

    def __init__(self, function: Callable[[str], bytes], longest: int = 100):
        self.function, self.longest = function, longest

    def __missing__(self, key: str) -> bytes:
        value = self.function(key)
        if len(key) < self.longest:
            if len(self) >= KEPT_CHUNKS:
                self.clear()
            self[key] = value
        return value


class WordEncoder:
    """Token ids of the tokenizers library for a file that drops white space.

    No word spans a blank or a line break, so the ids of a text are those of its
    chunks between them, in order; chunks and words repeat and are encoded once.
    """

    BYTE_LETTERS = _byte_letters()

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.known = Known(self.encoded)
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or "(?!)")

    def word(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.translate(self.BYTE_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def encoded(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if PLAIN.fullmatch(chunk) is None or self.special.search(chunk) is not None:
            return array("I", self.library.encode(chunk, add_special_tokens=False).ids).tobytes()
        lower = chunk.lower()
        words = [lower] if chunk.isalpha() else PLAIN_WORDS.findall(lower)
        if words == [chunk]:
            return self.word(chunk)
        if lower != chunk and self.special.search(lower) is not None:
            return b"".join(map(self.word, words))
        return b"".join(map(self.known.__getitem__, words))

    def texts(self, column: pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text, null being empty.

        Looking up every chunk by itself costs more than encoding the new ones, so each
        stretch of the column looks up its different chunks.
        """
        column = pc.fill_null(column, "")
        ends = np.cumsum(pc.binary_length(column).to_numpy())
        at = 0
        while at < len(column):
            held = ends[at - 1] if at else 0
            till = max(at + 1, int(np.searchsorted(ends, held + STRETCH_BYTES, side="right")))
            yield from self._stretch(column.slice(at, till - at))
            at = till

    def _stretch(self, column: pa.Array) -> Iterator[bytes]:
        split = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        told = split.flatten().dictionary_encode()
        different = list(map(self.known.__getitem__, told.dictionary.to_pylist()))
        ids = pa.array(different, pa.large_binary()).take(told.indices)
        places = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy())])
        chunks = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
        _, offsets, data = ids.buffers()
        begin = int(np.frombuffer(offsets, np.int64, 1, 8 * ids.offset)[0])
        edges = (places[chunks] + begin).tolist()
        whole = memoryview(data or b"")
        for a, b in zip(edges, edges[1:]):
            yield bytes(whole[a:b])

    def text(self, text: str) -> bytes:
        return next(self.texts(pa.array([text], pa.string())))


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class BestFit:
    """At most ``open_bins`` bins, found by free space through the bits of one integer."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins, self.n_open, self.bits = capacity, open_bins, 0, 0
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def put(self, size: int) -> tuple[int, int]:
        """Bin number and offset for a piece of ``size``."""
        at_least = self.bits >> size
        if at_least:
            free = size + (at_least & -at_least).bit_length() - 1
            number, fill = self._take(free)
        else:
            if self.n_open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, fill = self.made, 0
            self.made += 1
        left = self.capacity - fill - size
        if left:
            self.bins[left].append((number, fill + size))
            self.bits |= 1 << left
            self.n_open += 1
        return number, fill

    def _take(self, free: int) -> tuple[int, int]:
        held = self.bins[free]
        taken = held.pop()
        if not held:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return taken


def token_pieces(
    docs: DataFrame,
    path: str,
    end: int,
    capacity: int = CAPACITY,
    id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: each text's ids, then ``end``.

    Columns: ``id``, piece, start, length, ids_crc32 and, on demand, ids. A null or
    empty text is one piece of the end id alone. Repeated rows give repeated pieces.
    """
    kind = docs.schema[id].dataType.simpleString()
    closing = array("I", [end]).tobytes()
    fields = [
        ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, pieces, starts, sizes, sums, ids = [], [], [], [], [], []
        for row, data in enumerate(encoder(path).texts(batch.column(1))):
            data += closing
            for piece, at in enumerate(range(0, len(data), capacity * 4)):
                part = data[at : at + capacity * 4]
                rows.append(row)
                pieces.append(piece)
                starts.append(at // 4)
                sizes.append(len(part) // 4)
                sums.append(zlib.crc32(part))
                if with_ids:
                    ids.append(array("I", part).tolist())
        columns = [pieces, starts, sizes, sums] + ([ids] if with_ids else [])
        arrays = [batch.column(0).take(pa.array(rows, pa.int64()))]
        arrays += [pa.array(c, t) for c, (_, t) in zip(columns, fields)]
        return pa.RecordBatch.from_arrays(arrays, names=[id, *(n for n, _ in fields)])

    schema = f"`{id}` {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    return map_batches(docs.select(docs[id], docs[text]), cut, schema)


def best_fit(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` must be within 1 and ``capacity``.

    Pieces are dealt evenly to tasks of about ``pieces_per_task``, each of which packs
    what it gets, so that few bins are left open in the end whatever the input size.
    Only numbers and lengths go there; the places join the pieces again afterwards.
    An empty input gives no rows. The order inside a task follows a hash of the piece's
    number, so a task that runs again packs the same.
    """
    fixed = stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    tasks = max(1, -(-fixed.count() // pieces_per_task))
    small_batches(pieces.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, bins = TaskContext.get().partitionId(), BestFit(capacity, open_bins)
        for batch in batches:
            placed = [bins.put(n) for n in batch.column(1).to_pylist()]
            numbers = pa.array([(task << 40) + number for number, _ in placed], pa.int64())
            offsets = pa.array([offset for _, offset in placed], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), numbers, offsets], names=["_row", "sequence_id", "offset"]
            )

    mixed = fixed.select("_row", "length", F.xxhash64("_row").alias("_order"))
    dealt = mixed.repartition(tasks, "_order").sortWithinPartitions("_order", "_row")
    places = dealt.drop("_order").mapInArrow(pack, "_row long, sequence_id long, offset long")
    return fixed.join(places, "_row").drop("_row")
