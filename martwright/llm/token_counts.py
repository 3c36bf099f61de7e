"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-pair encoding has exactly one valid last token at every prefix of a word:
the one that fits behind the last token of the shorter prefix. Following it gives
the token count of every prefix in one pass, so that questions about truncation and
budgets need no further encoding. Words repeat, so counts are kept per chunk.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from martwright.llm.common import map_batches, record_batch, texts_of

CHUNK = re.compile(r" (?=\S)")
ASCII_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
)
CONTRACTIONS = ("'re", "'ve", "'ll")
#: Python counts four more control characters as spaces; such chunks go to the library.
ODD_SPACES = re.compile("[\x1c-\x1f]")
KEPT_CHUNKS = 800_000


class PrefixCounter:
    """Counts tokens as the tokenizers library does for a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.vocabulary = model["model"]["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        #: The merge that made each token, and when; letters have none.
        self.made = {a + b: (rank, a, b) for (a, b), rank in self.ranks.items()}
        self.whole = {t for t in self.vocabulary if self.merged(t) == [t]}
        sizes: dict[str, set[int]] = {}
        for token in self.whole:
            sizes.setdefault(token[-2:], set()).add(len(token))
        self.sizes = {tail: sorted(found, reverse=True) for tail, found in sizes.items()}
        self.special = [t["content"] for t in model["added_tokens"]]
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.fits = lru_cache(maxsize=1 << 20)(self._fits)
        self.bytes_as = self._byte_letters()
        self.chunks: dict[str, int] = {}
        self.words: dict[str, int] = {}

    @staticmethod
    def _byte_letters() -> dict[int, str]:
        """The printable character that stands for each byte in the vocabulary."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in plain)
        return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def merged(self, word: str) -> list[str]:
        """Merges applied one by one, the earliest learned first."""
        parts = list(word)
        while len(parts) > 1:
            ranked = [self.ranks.get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
            best = min(ranked)
            if best == 1 << 60:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, before: str, token: str) -> bool:
        """Whether two neighbours stay apart.

        The last merge inside either of them is undone, step by step. They would have
        joined across the border if a pair standing there had come before that merge;
        of equal merges the left one comes first.
        """
        limit, letter = 1 << 60, (-1, "", "")
        while self.ranks.get((before, token), limit) >= limit:
            left, right = self.made.get(before, letter), self.made.get(token, letter)
            if left[0] > right[0]:
                limit, before = left[0], left[2]
            elif right[0] >= 0:
                limit, token = right[0] + 1, right[1]
            else:
                return True
        return False

    def prefixes(self, word: str) -> list[int]:
        """Token count of each prefix of a word in the vocabulary's letters."""
        last, counts = [""], [0]
        whole, fits, sizes = self.whole, self.fits, self.sizes
        for end in range(1, len(word) + 1):
            for size in sizes.get(word[max(0, end - 2) : end], ()):
                start = end - size
                if start >= 0 and (token := word[start:end]) in whole:
                    if start == 0 or fits(last[start], token):
                        break
            else:
                start, token = end - 1, word[end - 1]
            last.append(token)
            counts.append(counts[start] + 1)
        return counts

    def split(self, chunk: str) -> list[str]:
        """The words of a chunk in the vocabulary's letters."""
        if chunk.isascii() and not ODD_SPACES.search(chunk):
            letters = self.bytes_as
            return [w.translate(letters) for w in ASCII_WORDS.findall(chunk)]
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def chunk(self, chunk: str) -> int:
        total = 0
        for word in self.split(chunk):
            count = self.words.get(word)
            if count is None:
                if len(self.words) >= KEPT_CHUNKS:
                    self.words.clear()
                count = self.words[word] = self.prefixes(word)[-1]
            total += count
        return total

    def _segment(self, text: str) -> int:
        """A space before a non-space starts a word, so a text can be cut there."""
        if not text:
            return 0
        first, *others = CHUNK.split(text)
        total, chunks = self.chunk(first), self.chunks
        get = chunks.get
        for part in others:
            count = get(part)
            if count is None:
                count = self.chunk(" " + part)
                if len(part) < 100:
                    if len(chunks) >= KEPT_CHUNKS:
                        chunks.clear()
                    chunks[part] = count
            total += count
        return total

    def _segments(self, text: str) -> Iterator[tuple[str, bool]]:
        at = 0
        for found in self.cut.finditer(text) if self.cut else ():
            yield text[at : found.start()], False
            yield found.group(), True
            at = found.end()
        yield text[at:], False

    def count(self, text: str) -> int:
        if self.cut is None or not any(s in text for s in self.special):
            return self._segment(text)
        return sum(1 if special else self._segment(part) for part, special in self._segments(text))

    def at_every_prefix(self, text: str) -> list[int]:
        """Token count of ``text[:i]`` for i from 0 to its length.

        A prefix that ends inside a word keeps the words before it. Only three ends
        change words before the last one: inside a run of spaces, which is one word
        until something follows; inside a contraction; inside a special string.
        """
        counts, base, done = [0], 0, ""
        for part, special in self._segments(text):
            if special:
                for i in range(1, len(part)):
                    counts.append(base - self._segment(done) + self._segment(done + part[:i]))
                base, done = base + 1, ""
                counts.append(base)
                continue
            before = base
            run, run_base = "", 0
            for chunk in self._words_in_place(part):
                for i in range(1, len(chunk) + 1):
                    head = chunk[:i]
                    if head.isspace() and not ODD_SPACES.search(head):
                        start = run_base if run else base
                        counts.append(start + self.chunk(run + head))
                    elif i < len(chunk) and chunk in CONTRACTIONS:
                        counts.append(base + self.chunk(head))
                    else:
                        counts.append(base + self._word(head))
                if chunk.isspace():
                    run, run_base = run + chunk, run_base if run else base
                else:
                    run = ""
                base += self._word(chunk)
            done = part if base > before else ""
        return counts

    def _word(self, word: str) -> int:
        letters = "".join(self.bytes_as[b] for b in word.encode())
        return self.prefixes(letters)[-1]

    def _words_in_place(self, text: str) -> list[str]:
        """The library's words as pieces of the text itself."""
        placed = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in placed]


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame, path: str, limit: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Bytes and tokens of every text, and whether the tokens exceed ``limit``.

    A null text counts as empty: no bytes, no tokens. Rows are independent, so
    repeated rows, null ids and other columns need no care; only ``id`` and
    ``text`` are read. ``path`` is a byte-level BPE file that all workers can read.
    """
    kind = docs.schema[id].dataType.simpleString()

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = [counter(path).count(t) for t in texts_of(batch.column(1))]
        size = pc.cast(pc.fill_null(pc.binary_length(batch.column(1)), 0), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), size, pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
            names=[id, "n_bytes", "n_tokens", "over_limit"],
        )

    schema = f"`{id}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(docs.select(docs[id], docs[text]), counted, schema)


def prefix_table(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text with ``counts``: the exact token count of each of its prefixes.

    ``counts[i]`` belongs to the first ``i`` characters; a null text has ``[0]``.
    The longest prefix within a budget is the last position whose count fits.
    """
    kind = docs.schema[id].dataType.simpleString()

    def tabled(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [counter(path).at_every_prefix(t) for t in texts_of(batch.column(1))]
        schema = pa.schema([(id, batch.column(0).type), ("counts", pa.list_(pa.int32()))])
        return record_batch({id: batch.column(0), "counts": counts}, schema)

    return map_batches(docs.select(docs[id], docs[text]), tabled, f"`{id}` {kind}, counts array<int>")


def longest_prefix(counts: list[int], budget: int) -> int:
    """Most characters whose tokens fit the budget."""
    return max(i for i, n in enumerate(counts) if n <= budget)
