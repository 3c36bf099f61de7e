"""Benchmark passages in documents, within an edit budget.

An item within ``k`` edits of a passage leaves at least one of its ``k + 1`` pieces
intact. All pieces are searched for at once, and what surrounds a hit is verified with
Myers' bit-parallel edit distance.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import small_batches, texts_of

#: Edits allowed, as a share of an item's characters, and the shortest item that may have
#: any. Shorter ones are looked for as they are, between word borders.
ERROR_RATE = 0.06
MIN_CHARS = 30
#: Characters of items searched for in one pass over the documents.
BLOCK_CHARS = 2_000_000
WORD = re.compile(r"\S+")
#: Characters of scripts that do not set words apart.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def lowered(text: str) -> str:
    """Lower case without a change of length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normal(text: str) -> str:
    """Lower case with one blank between words."""
    return " ".join(lowered(text).split())


def _in_word(c: str) -> bool:
    return (c.isalnum() or unicodedata.category(c)[0] == "M") and not UNSPACED.match(c)


def between_borders(text: str, a: int, b: int) -> bool:
    """Whether neither end of ``text[a:b]`` lies inside a word."""
    return not (
        (a > 0 and _in_word(text[a - 1]) and _in_word(text[a]))
        or (b < len(text) and _in_word(text[b - 1]) and _in_word(text[b]))
    )


class Offsets:
    """Places of the normal form in the text it was made from."""

    def __init__(self, text: str):
        self.text_at, self.normal_at, at = [], [], 0
        for word in WORD.finditer(text):
            self.text_at.append(word.start())
            self.normal_at.append(at)
            at += word.end() - word.start() + 1

    def of(self, at: int) -> int:
        word = bisect_right(self.normal_at, at) - 1
        return self.text_at[word] + at - self.normal_at[word]


class Pattern:
    """One item, with the bit masks of its characters."""

    def __init__(self, text: str, budget: int):
        self.text, self.budget = text, budget
        self.masks = self._masks(text)
        self.back = self._masks(text[::-1])

    @staticmethod
    def _masks(text: str) -> dict[str, int]:
        masks: dict[str, int] = {}
        for i, c in enumerate(text):
            masks[c] = masks.get(c, 0) | 1 << i
        return masks

    def pieces(self) -> Iterator[tuple[int, str]]:
        """Offsets and texts of the budget-plus-one pieces, of nearly equal length."""
        parts = self.budget + 1
        cuts = [len(self.text) * i // parts for i in range(parts + 1)]
        for a, b in zip(cuts, cuts[1:]):
            yield a, self.text[a:b]

    def nearest(self, window: str, masks: dict[str, int], anchored: bool = False) -> tuple[int, int]:
        """Least distance of the item to a part of ``window``, and where that part ends.

        The columns of the edit matrix are held as two integers of vertical differences.
        ``anchored`` makes the part start where the window starts.
        """
        size = len(self.text)
        full, top = (1 << size) - 1, 1 << (size - 1)
        up, down, score = full, 0, size
        best, end = size, 0
        for at, c in enumerate(window, 1):
            match = masks.get(c, 0)
            diagonal = (((match & up) + up) ^ up) | match | down
            right = down | ~(diagonal | up) & full
            left = up & diagonal
            if right & top:
                score += 1
            elif left & top:
                score -= 1
            right = (right << 1 | anchored) & full
            left = left << 1 & full
            up = left | ~(diagonal | right) & full
            down = right & diagonal
            if score < best:
                best, end = score, at
        return best, end

    def find(self, window: str) -> tuple[int, int, int] | None:
        """Distance, start and end of the nearest part of ``window`` within the budget."""
        distance, end = self.nearest(window, self.masks)
        if distance > self.budget:
            return None
        before = window[max(0, end - len(self.text) - self.budget) : end][::-1]
        _, size = self.nearest(before, self.back, anchored=True)
        return distance, end - size, end


class Search:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        import ahocorasick

        budgets = [max(1, int(len(text) * rate)) if len(text) >= MIN_CHARS else 0 for _, text in items]
        self.items = [(id, Pattern(text, budget)) for (id, text), budget in zip(items, budgets)]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, pattern) in enumerate(self.items):
            for offset, piece in pattern.pieces():
                places.setdefault(piece, []).append((number, offset + len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, found)
        if places:
            self.automaton.make_automaton()

    def windows(self, text: str) -> Iterator[tuple[int, int, int]]:
        """Item number and the stretch of text around each cluster of its hits."""
        starts: dict[int, set[int]] = {}
        for end, found in self.automaton.iter(text):
            for number, offset in found:
                starts.setdefault(number, set()).add(end + 1 - offset)
        for number, found in starts.items():
            pattern = self.items[number][1]
            slack, size = pattern.budget, len(pattern.text)
            ordered = sorted(found)
            first = last = ordered[0]
            for start in [*ordered[1:], None]:
                if start is not None and start - last <= 2 * slack:
                    last = start
                    continue
                yield number, max(0, first - slack), last + size + slack
                if start is not None:
                    first = last = start

    def passages(self, text: str) -> Iterator[tuple[int, tuple[int, int, int]]]:
        """Item number, and distance, start and end in ``text`` of passages within its budget."""
        for number, a, b in self.windows(text):
            pattern = self.items[number][1]
            if not pattern.budget:
                # The only piece is the item itself, so the window is a copy of it.
                if between_borders(text, a, b):
                    yield number, (0, a, b)
            elif match := pattern.find(text[a:b]):
                yield number, (match[0], match[1] + a, match[2] + a)

    def matches(self, text: str) -> list[tuple[object, int, int, int]]:
        """Item id, distance, start and end in ``text`` of each item's nearest passage."""
        if not self.items:
            return []
        found: dict[int, tuple[int, int, int]] = {}
        for number, placed in self.passages(text):
            found[number] = min(found.get(number, placed), placed)
        return [(self.items[n][0], *match) for n, match in sorted(found.items())]

    def any_match(self, text: str) -> bool:
        return any(True for _ in self.passages(text)) if self.items else False


_latest: list[tuple[list, float, Search]] = []


def _search(items: list[tuple[object, str]], rate: float) -> Search:
    """The automaton of a block, made once per worker for the block it works on.

    The block itself is held beside it, so that no other object can be taken for it.
    """
    if not (_latest and _latest[0][0] is items and _latest[0][1] == rate):
        _latest[:] = [(items, rate, Search(items, rate))]
    return _latest[0][2]


def _blocks(items: DataFrame, id: str, text: str) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of bounded size, so that what goes to every task is bounded too."""
    told = items.select(items[id].alias("id"), items[text].alias("text")).where("text is not null")
    chars = told.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    for number in range(blocks):
        part = told.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number)
        rows = [(r["id"], normal(r["text"])) for r in part.orderBy("id", "text").collect()]
        yield [(id, text) for id, text in rows if text]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    rate: float = ERROR_RATE,
    id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """One row per document and item found in it: ids, distance, start and end.

    Texts are compared in lower case with runs of white space as one blank; ``start`` and
    ``end`` are characters of the document's own text. An item may differ by ``rate`` of
    its characters, at least one. Items under ``MIN_CHARS`` characters are looked for
    without a difference and between word borders; empty and null ones are not looked for.
    Null texts hold nothing. Repeated rows give repeated rows.
    The items are searched for in blocks, each of which reads the documents once.
    """
    spark = docs.sparkSession
    small_batches(spark)
    told = docs.select(docs[id], docs[text])
    kinds = docs.schema[id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"`{id}` {kinds[0]}, `{item_id}` {kinds[1]}, distance int, start int, end int"
    found = None
    for block in _blocks(items, item_id, text):
        shared = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matches = _search(shared.value, rate).matches
            for batch in batches:
                rows: list[tuple] = []
                for at, text in enumerate(texts_of(batch.column(1))):
                    if found := matches(normal(text)):
                        places = Offsets(text)
                        rows += ((at, i, d, places.of(a), places.of(b - 1) + 1) for i, d, a, b in found)
                at, item, *others = zip(*rows) if rows else [()] * 5
                columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(item)]
                if not rows:
                    continue
                columns += [pa.array(c, pa.int32()) for c in others]
                yield pa.RecordBatch.from_arrays(columns, names=[id, item_id, "distance", "start", "end"])

        part = told.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(
    docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    spark = docs.sparkSession
    small_batches(spark)
    place = docs.columns.index(text)
    for block in _blocks(items, item_id, "text"):
        shared = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = _search(shared.value, rate).any_match
            for batch in batches:
                keep = [not found(normal(t)) for t in texts_of(batch.column(place))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
