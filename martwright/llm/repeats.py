"""Passages that repeat across documents, found through Burrows-Wheeler transforms.

Any passage of the minimum length holds one anchor, the least hash of its inner
stretches, so equal passages meet in the bucket of their anchor. Every bucket builds a
Burrows-Wheeler transform of its pieces and derives common prefixes by increasing
value: intervals are extended backward, breadth first, and stop at the minimum length.
Many pieces have an anchor in common by chance, and the more so the more text there is;
those around one anchor are cut again by longer stretches, and only what shares one of
these with another document is transformed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import map_batches, small_batches, stored, texts_of

MIN_BYTES = 50
ANCHOR = 16
WINDOW = MIN_BYTES - ANCHOR + 1
#: Longest piece: as many starts as one anchor can serve in plain text.
LONGEST = MIN_BYTES + WINDOW - 1
UNIT_BYTES = 4 << 20
#: Units dealt to the buckets together, so that there are fewer and larger messages.
DEALT_UNITS = 4
#: Input bytes per bucket; its pieces come to some four times that.
BUCKET_BYTES = 6 << 20
#: Pieces compared in one transform; more are compared anchor by anchor in turn.
TRANSFORM_BYTES = 2 << 20
#: Stretches by which the pieces around one anchor are cut again, then those around one such
#: stretch if they come to more than a transform.
CORES = (32, 48)
#: Places hashed at once, a multiple of 64: few enough that their numbers stay in a core's cache.
HASHED_PLACES = 1 << 14
SEPARATOR = 0xFF

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * _ODD[1]
    x += b
    x ^= x >> np.uint64(29)
    x *= _ODD[2]
    x ^= x >> np.uint64(32)
    return x


def _words(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The eight bytes from every place on as one number, without a copy."""
    return np.ndarray((max(0, len(data) - 7),), kind, data, strides=(1,))


def _hash_of(words: list[np.ndarray]) -> np.ndarray:
    while len(words) > 1:
        words = [_mix(a, b) for a, b in zip(words[::2], words[1::2])]
    return words[0]


def stretches_at(data: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes, 8 times a power of two, from each place on."""
    words = _words(data)
    return _hash_of([words[places + at] for at in range(0, size, 8)])


def least_stretches(data: np.ndarray, places: int) -> np.ndarray:
    """Least hash of the stretches that begin in the window of each place.

    Its last six bits tell the place of the stretch, as the remainder by 64; those of the
    hash are dropped. ``data`` reaches a passage beyond the last place.
    """
    least = np.empty(places, np.uint64)
    marks = np.arange(HASHED_PLACES + WINDOW - 1, dtype=np.uint64) & np.uint64(63)
    for at in range(0, places, HASHED_PLACES):
        till = min(places, at + HASHED_PLACES)
        words = _words(data[at : till + MIN_BYTES - 1])
        hashes = _hash_of([words[:-8].copy(), words[8:]])
        hashes &= ~np.uint64(63)
        hashes |= marks[: len(hashes)]
        least[at:till] = _sliding_least(hashes, WINDOW)
    return least


def _core_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes, 32 or 48, from each place on: one or two stretches of 32."""
    words = _words(data)
    ends = len(words) - 24
    found = _hash_of([words[at : at + ends].copy() for at in range(0, 32, 8)])
    return found if size == 32 else _mix(found[: 32 - size], found[size - 32 :])


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


class Pieces:
    """Pieces of texts: where their bytes lie in ``data``, and whose they are.

    ``mark`` is the place of the anchor in the piece, ``at`` that of the piece in its text.
    """

    def __init__(self, data: np.ndarray, begin: np.ndarray, size: np.ndarray, mark: np.ndarray, doc: np.ndarray, at: np.ndarray):
        self.data, self.begin, self.size, self.mark, self.doc, self.at = data, begin, size, mark, doc, at

    def __len__(self) -> int:
        return len(self.begin)

    def take(self, rows: np.ndarray | slice) -> Pieces:
        return Pieces(self.data, *(x[rows] for x in (self.begin, self.size, self.mark, self.doc, self.at)))

    def anchors(self) -> np.ndarray:
        return stretches_at(self.data, self.begin + self.mark, ANCHOR)

    def keys(self) -> np.ndarray:
        """Hash of all the bytes of each piece: three overlapping stretches and the size."""
        wide = 2 * ANCHOR
        key = self.size.astype(np.uint64)
        for place in (0, (self.size - wide) // 2, self.size - wide):
            key = _mix(key, stretches_at(self.data, self.begin + place, wide))
        return key

    def bytes(self) -> np.ndarray:
        """The bytes of all pieces, one after the other."""
        return self.data[_ranges(self.begin, self.size)]


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its size."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - size - begin, size)


def cut_pieces(docs: list[tuple[int, int, bytes]]) -> Pieces:
    """Pieces of segments given as (doc id, place in the text, bytes).

    A piece joins neighbouring passages of the minimum length that have the same anchor.
    """
    sizes = np.array([len(d) for *_, d in docs], np.int64)
    data = np.frombuffer(b"".join(d for *_, d in docs) + b"\xff" * LONGEST, np.uint8)
    total = len(data) - LONGEST
    begins = np.cumsum(sizes) - sizes
    ends = begins + np.maximum(0, sizes - MIN_BYTES + 1)
    least = least_stretches(data, total)
    fresh = np.zeros(total + 1, bool)
    np.greater(least[1:] ^ least[:-1], np.uint64(63), out=fresh[1:total])
    # No passage starts in the last bytes of a text: they are a run that is left out.
    fresh[_ranges(ends, begins + sizes - ends)] = False
    fresh[begins] = fresh[ends] = fresh[total] = True
    first = np.flatnonzero(fresh)
    length = np.diff(first)
    own = np.searchsorted(begins, first[:-1], side="right") - 1
    whole = np.flatnonzero(first[:-1] < ends[own])
    first, length, own = first[whole], length[whole], own[whole]
    # A text that repeats itself would keep one anchor for long; such runs are cut.
    cuts = -(-length // WINDOW)
    skip = _ranges(np.zeros(len(cuts), np.int64), cuts) * WINDOW
    begin, own = np.repeat(first, cuts) + skip, np.repeat(own, cuts)
    size = np.minimum(np.repeat(length, cuts) - skip, WINDOW) + MIN_BYTES - 1
    mark = (least[begin].astype(np.int64) - begin) & 63
    ids = np.array([d for d, *_ in docs], np.int64)
    offsets = np.array([o for _, o, _ in docs], np.int64)
    return Pieces(data, begin, size, mark, ids[own], begin - begins[own] + offsets[own])


def joined(parts: list[Pieces]) -> Pieces:
    """All the pieces of several units."""
    skip = np.cumsum([0, *(len(p.data) for p in parts[:-1])])
    begin = np.concatenate([p.begin + n for p, n in zip(parts, skip)])
    rest = (np.concatenate([getattr(p, name) for p in parts]) for name in ("size", "mark", "doc", "at"))
    return Pieces(np.concatenate([p.data for p in parts]), begin, *rest)


def cut_again(pieces: Pieces, core: int) -> tuple[Pieces, np.ndarray, np.ndarray]:
    """Parts of pieces, whose they are, and the least hash of the ``core`` bytes within them.

    A part joins neighbouring passages of one piece with the same least hash, so equal
    passages of two pieces lie in parts with the same hash. ``at`` of a part is its place in
    the piece.
    """
    window = MIN_BYTES - core + 1
    parts: list[tuple[np.ndarray, ...]] = []
    total = np.cumsum(pieces.size)
    first = 0
    while first < len(pieces):
        till = int(np.searchsorted(total, (total[first - 1] if first else 0) + HASHED_PLACES)) + 1
        block = pieces.take(slice(first, till))
        ends = np.cumsum(block.size)
        begins = ends - block.size
        least = _sliding_least(_core_hashes(block.bytes(), core), window)
        starts = block.size - MIN_BYTES + 1
        places = _ranges(begins, starts)
        own = np.repeat(np.arange(len(block)), starts)
        least = least[places]
        fresh = np.ones(len(places), bool)
        fresh[1:] = (least[1:] != least[:-1]) | (own[1:] != own[:-1])
        cuts = np.flatnonzero(fresh)
        size = np.diff(np.append(cuts, len(places))) + MIN_BYTES - 1
        parts.append((first + own[cuts], places[cuts] - begins[own[cuts]], size, least[cuts]))
        first = till
    own, at, size, least = (np.concatenate(p) for p in zip(*parts))
    mark = np.zeros(len(own), np.int64)
    return Pieces(pieces.data, pieces.begin[own] + at, size, mark, pieces.doc[own], at), own, least


def pack(pieces: Pieces) -> bytes:
    import zstandard

    columns = [
        np.array([len(pieces)], np.int64), pieces.doc.astype(np.int64), pieces.at.astype(np.int64),
        pieces.size.astype(np.uint8), pieces.mark.astype(np.uint8), pieces.bytes(),
    ]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def unpack(blobs: list[bytes]) -> Pieces:
    import zstandard

    parts: list[list[np.ndarray]] = [[], [], [], [], []]
    decoder = zstandard.ZstdDecompressor()
    for blob in blobs:
        raw = decoder.decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        at = 8
        for part, kind, width in zip(parts, (np.int64, np.int64, np.uint8, np.uint8), (8, 8, 1, 1)):
            part.append(np.frombuffer(raw, kind, n, at))
            at += n * width
        parts[4].append(np.frombuffer(raw, np.uint8, -1, at))
    doc, place, size, mark, data = (np.concatenate(p) for p in parts)
    size = size.astype(np.int64)
    return Pieces(data, np.cumsum(size) - size, size, mark.astype(np.int64), doc, place)


def _suffix_order(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of what follows them, and common prefixes of neighbours below 8.

    Ranks of 8 bytes are doubled until they cover the minimum length.
    """
    n = len(data)
    key = _words(np.append(data, np.full(7, SEPARATOR, np.uint8)), ">u8").astype(np.uint64)
    order = np.argsort(key).astype(np.int32)
    ordered = key[order]
    differ = ordered[1:] ^ ordered[:-1]
    shared = np.zeros(n + 1, np.int8)
    for size in range(1, 8):
        shared[1:n] += differ < np.uint64(1 << (64 - 8 * size))
    shared[1:n][differ == 0] = -1
    size = 8
    while size < MIN_BYTES:
        fresh = np.append(0, ordered[1:] != ordered[:-1])
        rank = np.empty(n + size, np.int32)
        rank[order] = np.cumsum(fresh, dtype=np.int32)
        rank[n:] = n
        key = rank[:n].astype(np.int64) << 32 | rank[size:]
        order = np.argsort(key).astype(np.int32)
        ordered = key[order]
        size *= 2
    return order, shared


def common_prefixes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of ``data``, and the common prefix of each entry with the one before.

    Values from the minimum length on are left at -1. ``data`` holds texts that each end
    with a separator. Short values come with the order; then intervals are extended
    backward level by level: an interval of texts that begin alike, taken with each byte
    that stands before one of them, is the interval of the longer text. The border behind
    it has the level as its value if it has none yet, and only then it is extended later.
    """
    order, shared = _suffix_order(data)
    before = data[order - 1]
    to_first = np.empty(len(data), np.int32)
    to_first[np.argsort(before, kind="stable")] = np.arange(len(data), dtype=np.int32)
    borders = np.flatnonzero(shared >= 0)
    now = np.flatnonzero(shared[borders] == 7)
    low, high = borders[now - 1], borders[now]
    for level in range(8, MIN_BYTES):
        single = high - low == 1
        at = low[single]
        at = at[before[at] != SEPARATOR]
        first = to_first[at]
        lows, highs = [first], [first + 1]
        low, high = low[~single], high[~single]
        if len(low):
            size = high - low
            inside = _ranges(low, size)
            owner = np.repeat(np.arange(len(low)), size)
            open_ = before[inside] != SEPARATOR
            inside, owner = to_first[inside[open_]], owner[open_]
            # Places before one byte stay together, so each longer text is a run.
            sorting = np.argsort(inside)
            inside, owner = inside[sorting], owner[sorting]
            cut = np.ones(len(inside) + 1, bool)
            cut[1:-1] = (inside[1:] != inside[:-1] + 1) | (owner[1:] != owner[:-1])
            cut[1:-1] |= data[order[inside[1:]]] != data[order[inside[:-1]]]
            ends = np.flatnonzero(cut)
            lows.append(inside[ends[:-1]])
            highs.append(inside[ends[1:] - 1] + 1)
        low, high = np.concatenate(lows), np.concatenate(highs)
        new = shared[high] < 0
        low, high = low[new], high[new]
        shared[high] = level
        if not len(low):
            break
    return order, shared[: len(data)]


def repeated_starts(pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct pieces: the number of a piece and a start in it, for every passage of
    the minimum length that also starts in a piece of a smaller document."""
    with_mark = Pieces(pieces.data, pieces.begin, pieces.size + 1, pieces.mark, pieces.doc, pieces.at)
    ends = np.cumsum(with_mark.size)
    data = np.append(pieces.data, np.uint8(0))[_ranges(pieces.begin, with_mark.size)]
    data[ends - 1] = SEPARATOR
    order, shared = common_prefixes(data)
    owner = np.repeat(np.arange(len(pieces)), with_mark.size)
    start = np.arange(len(data)) - (ends - with_mark.size)[owner]
    whole = start + MIN_BYTES <= pieces.size[owner]
    doc = np.where(whole, pieces.doc[owner], np.iinfo(np.int64).max)[order]
    groups = np.flatnonzero(shared >= 0)
    smallest = np.minimum.reduceat(doc, groups)
    smaller = np.repeat(smallest, np.diff(np.append(groups, len(doc)))) < doc
    found = order[smaller & whole[order]]
    found.sort()
    return owner[found], start[found]


def _transformed(pieces: Pieces, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces, in order of their anchors, and starts in them, as ``repeated_starts`` finds them."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    total = np.cumsum(pieces.size)
    at = 0
    while at < len(pieces):
        till = int(np.searchsorted(total, (total[at - 1] if at else 0) + TRANSFORM_BYTES)) + 1
        till = int(np.searchsorted(anchor, anchor[min(till, len(anchor)) - 1], side="right"))
        number, start = repeated_starts(pieces.take(slice(at, till)))
        parts.append((at + number, start))
        at = till
    return np.concatenate([n for n, _ in parts]), np.concatenate([s for _, s in parts])


def _among(pieces: Pieces, anchor: np.ndarray, cores: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of pieces, starts and ends in them of what a smaller document holds too.

    ``pieces`` are distinct around each anchor, and come in order of their anchors; equal
    passages have the same anchor. Spans of one piece are as long as they can be.
    """
    none = np.empty(0, np.int64)
    if not len(pieces):
        return none, none, none
    edges = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    count = np.diff(np.append(edges, len(anchor)))
    # At first all anchors are cut again, then those of more than a transform.
    large = len(cores) == len(CORES) or np.add.reduceat(pieces.size, edges) > TRANSFORM_BYTES
    again = np.repeat((count > 1) & large & bool(cores), count)
    plain = np.flatnonzero(np.repeat(count > 1, count) & ~again)
    number, start, end = none, none, none
    if len(plain):
        found, start = _transformed(pieces.take(plain), anchor[plain])
        number, end = plain[found], start + MIN_BYTES
    if again.any():
        rows = np.flatnonzero(again)
        parts, own, core = cut_again(pieces.take(rows), cores[0])
        chosen, starts, ends = _repeats(parts, core, cores[1:])
        at = parts.at[chosen]
        number = np.concatenate([number, rows[own[chosen]]])
        start, end = np.concatenate([start, at + starts]), np.concatenate([end, at + ends])
    # Neighbouring starts make one span; spans of one piece begin in the order they end.
    sorting = np.lexsort((start, number))
    number, start, end = number[sorting], start[sorting], end[sorting]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (number[1:] != number[:-1]) | (start[1:] > end[:-1] - MIN_BYTES + 1)
    begins = np.flatnonzero(fresh)
    lasts = np.append(begins[1:], len(start)) - 1 if len(start) else begins
    return number[begins], start[begins], end[lasts]


def _repeats(pieces: Pieces, anchor: np.ndarray, cores: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of pieces, starts and ends in them of what a smaller document holds too."""
    _, group = np.unique(anchor, return_inverse=True)
    low = np.full(group.max() + 1 if len(group) else 0, np.iinfo(np.int64).max)
    high = np.full(len(low), np.iinfo(np.int64).min)
    np.minimum.at(low, group, pieces.doc)
    np.maximum.at(high, group, pieces.doc)
    rows = np.flatnonzero((low < high)[group])
    pieces, anchor = pieces.take(rows), anchor[rows]
    if not len(pieces):
        return rows, np.empty(0, np.int64), np.empty(0, np.int64)
    # Equal pieces: all but those of the smallest document are repeats as a whole.
    _, first, text = np.unique(pieces.keys(), return_index=True, return_inverse=True)
    owner = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(owner, text, pieces.doc)
    whole = np.flatnonzero(pieces.doc > owner[text])
    held = np.flatnonzero(pieces.doc == owner[text])
    # Different pieces around one anchor are compared byte by byte.
    by_anchor = np.argsort(anchor[first], kind="stable")
    distinct = pieces.take(first[by_anchor])
    distinct.doc = owner[by_anchor]
    number, begin, end = _among(distinct, anchor[first][by_anchor], cores)
    number = by_anchor[number]
    # A span holds for every place of the piece.
    sorting = np.argsort(number, kind="stable")
    number, begin, end = number[sorting], begin[sorting], end[sorting]
    count = np.bincount(number, minlength=len(first))
    skip = np.cumsum(count) - count
    mine = count[text[held]]
    spans = _ranges(skip[text[held]], mine)
    chosen = np.concatenate([whole, np.repeat(held, mine)])
    starts = np.concatenate([np.zeros(len(whole), np.int64), begin[spans]])
    ends = np.concatenate([pieces.size[whole], end[spans]])
    return rows[chosen], starts, ends


def find_spans(pieces: Pieces) -> tuple[Pieces, np.ndarray, np.ndarray]:
    """Pieces, starts and ends in them of what a smaller document holds too."""
    rows, starts, ends = _repeats(pieces, pieces.anchors(), CORES)
    return pieces.take(rows), starts, ends


SPAN_TYPES = [("id", pa.int64()), ("start", pa.int64()), ("size", pa.int64()), ("check", pa.int64())]


def _span_columns(pieces: Pieces, starts: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    """Spans in the documents' texts, with a checksum of their bytes."""
    data = memoryview(np.ascontiguousarray(pieces.data))
    sums = [zlib.crc32(data[a:b]) for a, b in zip((pieces.begin + starts).tolist(), (pieces.begin + ends).tolist())]
    columns = (pieces.doc, pieces.at + starts, ends - starts, np.array(sums, np.int64))
    return [pa.array(c, pa.int64()) for c in columns]


def _within(pieces: Pieces) -> tuple[Pieces, np.ndarray]:
    """Pieces to send of one task's unit, and those that repeat a smaller document in it.

    Of equal pieces only those of the smallest document go on, so a passage that many
    documents hold is sent once from each unit.
    """
    _, text = np.unique(pieces.keys(), return_inverse=True)
    owner = np.full(text.max() + 1 if len(text) else 0, np.iinfo(np.int64).max)
    np.minimum.at(owner, text, pieces.doc)
    return pieces.take(np.flatnonzero(pieces.doc == owner[text])), np.flatnonzero(pieces.doc > owner[text])


def _segments(id: int, data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """A text in stretches that overlap by what a passage can reach over."""
    for at in range(0, max(1, len(data) - MIN_BYTES + 1), UNIT_BYTES):
        yield id, at, data[at : at + UNIT_BYTES + MIN_BYTES - 1]


def _cut(buckets: int):
    import xxhash

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
        unit, held = [], 0
        for batch in batches:
            for id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                for segment in _segments(id, text.encode()):
                    if len(segment[2]) >= MIN_BYTES:
                        unit.append(segment)
                        held += len(segment[2])
                    if held >= UNIT_BYTES:
                        yield unit
                        unit, held = [], 0
        if unit:
            yield unit

    def told(rows: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
        number, local, blob = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), pa.array(local, pa.bool_()), pa.array(blob, pa.binary())],
            names=["bucket", "local", "pieces"],
        )

    def dealt(units: list[Pieces]) -> Iterator[pa.RecordBatch]:
        """Messages to the buckets; the units are joined and given up."""
        pieces = joined(units)
        units.clear()
        anchor = pieces.anchors()
        bucket = (_mix(anchor, anchor) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        del anchor, bucket
        rows, size = [], 0
        for number, (x, y) in enumerate(zip(edges, edges[1:])):
            if y > x:
                rows.append((number, False, pack(pieces.take(order[x:y]))))
                size += len(rows[-1][2])
            if size >= UNIT_BYTES:
                yield told(rows)
                rows, size = [], 0
        if rows:
            yield told(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Pieces] = []
        for unit in units(batches):
            cuts = cut_pieces(unit)
            pieces, repeats = _within(cuts)
            if len(repeats):
                spread = xxhash.xxh32_intdigest(repr(unit[0][:2])) % buckets
                yield told([(spread, True, pack(cuts.take(repeats)))])
            held.append(pieces)
            del cuts, pieces, repeats
            if len(held) == DEALT_UNITS:
                yield from dealt(held)
        if held:
            yield from dealt(held)

    return cut


def _match(table: pa.Table) -> pa.Table:
    """Spans of one bucket."""
    blobs, local = table.column("pieces").to_pylist(), table.column("local").to_pylist()
    columns: list[list[pa.Array]] = []
    sent = [blob for blob, own in zip(blobs, local) if not own]
    if sent:
        columns.append(_span_columns(*find_spans(unpack(sent))))
    for blob in (blob for blob, own in zip(blobs, local) if own):
        pieces = unpack([blob])
        columns.append(_span_columns(pieces, np.zeros(len(pieces), np.int64), pieces.size))
    return pa.table({name: pa.chunked_array([c[i] for c in columns], kind) for i, (name, kind) in enumerate(SPAN_TYPES)})


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans (id, start, size, check) in bytes that also stand in a smaller document.

    Every passage of ``MIN_BYTES`` bytes of a document that also starts in one with a
    smaller id lies in a span; spans may overlap, and nothing else is covered.
    """
    small_batches(docs.sparkSession)
    told = docs.select(docs[id].cast("long").alias("id"), docs[text].alias("text")).where("id is not null and text is not null")
    size = told.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    cuts = told.mapInArrow(_cut(buckets), "bucket long, local boolean, pieces binary")
    return stored(cuts.groupBy("bucket").applyInArrow(_match, "id long, start long, size long, check long"), "spans")


def kept_bytes(data: bytes, spans: list[tuple[int, int, int]]) -> tuple[bytes, int]:
    """What is left of a text without its spans, and the number of removed runs.

    A span whose bytes do not match its checksum belongs to another text with the same
    id and is passed over.
    """
    parts, runs, end = [], 0, 0
    removed_to = -1
    for start, size, check in sorted(spans):
        stop = start + size
        if stop > len(data) or stop <= removed_to or zlib.crc32(data[start:stop]) != check:
            continue
        if start > removed_to:
            runs += 1
            parts.append(data[end:start])
        removed_to = end = stop
    parts.append(data[end:])
    return b"".join(parts), runs


def _with_spans(docs: DataFrame, spans: DataFrame, id: str) -> DataFrame:
    """``docs`` with all spans of a row's id beside it in ``_spans``."""
    gathered = spans.groupBy(F.col("id").alias("_span_id")).agg(
        F.collect_list(F.struct("start", "size", "check")).alias("_spans")
    )
    return docs.join(gathered, docs[id].cast("long") == F.col("_span_id"), "left").drop("_span_id")


def _spans_of(column: pa.Array) -> list[list[tuple[int, int, int]]]:
    fields = (column.values.field(name).to_pylist() for name in ("start", "size", "check"))
    spans, edges = list(zip(*fields)), column.offsets.to_pylist()
    return [spans[a:b] if here else [] for a, b, here in zip(edges, edges[1:], column.is_valid().to_pylist())]


def removal_report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id``, n_bytes, n_removed, n_spans and kept_sha256.

    A byte is removed when it lies in a passage of ``MIN_BYTES`` bytes that also starts in
    a document with a smaller id; touching spans count as one. A null text is empty. A row
    with a null id neither loses bytes nor makes others lose any. Repeated rows lose the
    same bytes; rows that share an id make each other lose none.
    """
    kind = docs.schema[id].dataType.simpleString()
    told = docs.select(docs[id], docs[text])
    joined = _with_spans(told, repeated_spans(docs, id, text), id)

    def report(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, removed, runs, digests = [], [], [], []
        for body, spans in zip(texts_of(batch.column(1)), _spans_of(batch.column(2))):
            data = body.encode()
            kept, n = kept_bytes(data, spans)
            sizes.append(len(data))
            removed.append(len(data) - len(kept))
            runs.append(n)
            digests.append(hashlib.sha256(kept).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in (sizes, removed, runs)), pa.array(digests, pa.string())],
            names=[id, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    return map_batches(joined, report, f"`{id}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the texts that are left; characters cut apart by a span go as a whole.

    Documents left empty stay, with an empty text; a null text stays null.
    """
    joined = _with_spans(docs, repeated_spans(docs, id, text), id)
    names, place = docs.columns, docs.columns.index(text)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        bodies = batch.column(place).to_pylist()
        spans = _spans_of(batch.column(batch.num_columns - 1))
        left = [
            b if b is None or not s else kept_bytes(b.encode(), s)[0].decode("utf-8", "ignore")
            for b, s in zip(bodies, spans)
        ]
        columns = batch.columns[:-1]
        columns[place] = pa.array(left, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(joined, cut, docs.schema)
