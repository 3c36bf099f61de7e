"""Near-duplicate documents by one-permutation MinHash.

Each document's set of word shingles is hashed once into bins; empty bins borrow from
random filled ones (optimal densification). Bands of bins make buckets, each of which
proposes a star of pairs around one center. Proposed pairs are confirmed on the full
sets, and confirmed links form components. Buckets that some stars do not settle are
finished by a join of their members' rarest shingles, which proposes every similar pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martwright.llm.common import map_batches, small_batches, stored, texts_of
from martwright.llm.components import components

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
KEPT_WORDS = 500_000
#: Rounds of stars around other centers, for members that the first center leaves out.
#: Buckets that are open after them are finished by their members' rare shingles.
CENTER_ROUNDS = 2

_MULTIPLIERS = np.random.default_rng(11).integers(1, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_words: dict[bytes, int] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hash(word: bytes) -> int:
    import xxhash

    if len(_words) >= KEPT_WORDS:
        _words.clear()
    found = _words[word] = xxhash.xxh64_intdigest(word)
    return found


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    Words are what stands between ASCII spaces, with A-Z in lower case. A text of fewer
    words than a shingle has one element, its whole sequence; one without words none.
    """
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    get = _words.get
    hashes = np.array([get(w) or _word_hash(w) for w in words], np.uint64)
    size = min(SHINGLE, len(hashes))
    total = np.full(len(hashes) - size + 1, size, np.uint64)
    for k in range(size):
        total = total + hashes[k : len(hashes) - size + 1 + k] * _MULTIPLIERS[k]
    return np.unique(_mixed(total))


def bins(shingles: np.ndarray) -> np.ndarray:
    """One value per bin: the least hash that falls into it, or that of a borrowed bin."""
    shift = np.uint64(64 - (BINS - 1).bit_length())
    where = (shingles >> shift).astype(np.int64)
    filled, first = np.unique(where, return_index=True)
    values, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[filled], full[filled] = shingles[first], True
    empty, attempt = np.flatnonzero(~full), 1
    while len(empty):
        probe = _mixed(empty.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        source = (probe % np.uint64(BINS)).astype(np.int64)
        found = full[source]
        values[empty[found]] = values[source[found]]
        empty, attempt = empty[~found], attempt + 1
    return values


def bands(values: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, different between bands."""
    rows = values.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(ROWS):
        key = _mixed(key + rows[:, k] * _MULTIPLIERS[k])
    return key.view(np.int64)


def set_key(shingles: np.ndarray) -> str:
    import xxhash

    return xxhash.xxh128_hexdigest(shingles.tobytes())


def signatures(docs: DataFrame, id: str, text: str) -> DataFrame:
    """id, n_shingles, the key of the whole set, and its band keys (null without words)."""
    kind = docs.schema[id].dataType.simpleString()

    def signed(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, keys, found = [], [], []
        for t in texts_of(batch.column(1)):
            shingles = shingle_set(t)
            sizes.append(len(shingles))
            keys.append(set_key(shingles) if len(shingles) else None)
            found.append(bands(bins(shingles)).tolist() if len(shingles) else None)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.string()),
                pa.array(found, pa.list_(pa.int64())),
            ],
            names=["id", "n_shingles", "set_key", "bands"],
        )

    return map_batches(
        docs.select(docs[id], docs[text]), signed, f"id {kind}, n_shingles long, set_key string, bands array<long>"
    )


def with_set_keys(docs: DataFrame, text: str = "text", name: str = "set_key") -> DataFrame:
    """``docs`` with the key of each text's set beside it, null without words."""
    names, place = docs.columns, docs.columns.index(text)

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = map(shingle_set, texts_of(batch.column(place)))
        keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*names, name])

    return map_batches(docs, keyed, StructType([*docs.schema.fields, StructField(name, StringType())]))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough.

    The texts of the members go to their centers by two joins; rows of one center arrive
    one after the other, so its set is made once per task.
    """
    small_batches(pairs.sparkSession)
    both = pairs.select("center", "member")
    for name in ("member", "center"):
        both = both.join(texts.select(F.col("node").alias(name), F.col("text").alias(f"{name}_text")), name)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, center = None, np.empty(0, np.uint64)
        for batch in batches:
            keep = []
            for at in range(batch.num_rows):
                key = batch.column(2)[at].as_py()
                if key != last:
                    last, center = key, shingle_set(key)
                member = shingle_set(batch.column(3)[at].as_py())
                common = len(np.intersect1d(center, member, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(center) + len(member) - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:2], names=["a", "b"])

    kind = pairs.schema["center"].dataType
    ordered = both.select("center", "member", "center_text", "member_text")
    return ordered.mapInArrow(confirm, StructType([StructField("a", kind), StructField("b", kind)])).distinct()


def _centers(entries: DataFrame, turn: int) -> DataFrame:
    """The center of each bucket of two and more: the smallest node at first, and in later
    turns the smallest hash of node, band and turn."""
    order = F.col("member") if turn == 0 else F.xxhash64("member", "band", F.lit(turn))
    center = F.struct(order.alias("order"), F.col("member").alias("center"))
    return (
        entries.groupBy("band")
        .agg(F.min(center).alias("c"), F.min("member").alias("low"), F.max("member").alias("high"))
        .where("low != high")
        .select("band", "c.center")
    )


def _stars(entries: DataFrame, turn: int) -> DataFrame:
    """Pairs of each bucket's center with its members.

    Only the center meets the others, so pairs stay within the number of entries.
    """
    return (
        entries.join(_centers(entries, turn), "band")
        .where("member != center")
        .groupBy("center", "member")
        .agg(F.count("*").alias("shared"))
    )


def _open(entries: DataFrame, turn: int, labels: DataFrame) -> DataFrame:
    """Entries whose bucket can still hold an unknown link after this turn.

    The center has met all the others and leaves its bucket; a bucket whose other members
    are of one component is settled.
    """
    rest = entries.join(_centers(entries, turn), "band").where("member != center").drop("center")
    rest = _labelled(rest, labels, "member")
    mixed = rest.groupBy("band").agg(F.min("member_in").alias("low"), F.max("member_in").alias("high"))
    mixed = mixed.where("low != high").select("band")
    return rest.join(mixed, "band", "left_semi").select("member", "band")


def _rare_pairs(entries: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """All pairs of the entries' members that can be similar enough, between components.

    The shingles of a set are ranked from the rarest on. In a similar pair, what follows
    the first common shingle in either set must hold the whole overlap, so that shingle
    ranks low in both, and lowest in the smaller one; what many texts share ranks high.
    """
    members = stored(_labelled(entries.select("member").distinct(), labels, "member"), "members")

    def shingled(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([shingle_set(t).view(np.int64) for t in texts_of(batch.column(1))], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column(0), found], names=["member", "shingles"])

    told = members.join(texts, F.col("member") == F.col("node")).select("member", "text")
    sets = stored(map_batches(told, shingled, "member long, shingles array<long>"), "sets")
    each = sets.select("member", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("member").orderBy("often", "shingle")).cast("long")
    ranked = each.join(often, "shingle").withColumn("rank", rank).where("often > 1")
    ranked = ranked.where(f"100 * (n - rank + 1) >= {PERCENT} * n").select("member", "n", "shingle", "rank")
    prefixes = stored(ranked.join(members, "member"), "prefixes")
    x = prefixes.where(f"{100 + PERCENT} * (n - rank + 1) >= {2 * PERCENT} * n").select(
        "shingle", F.col("member").alias("center"), F.col("member_in").alias("center_in"),
        F.col("n").alias("x_n"), F.col("rank").alias("x_rank"),
    )
    return (
        prefixes.join(x, "shingle")
        .where("member_in != center_in and (x_n < n or x_n = n and center < member)")
        .where(f"{100 + PERCENT} * (1 + least(n - rank, x_n - x_rank)) >= {PERCENT} * (n + x_n)")
        .select("center", "member")
        .distinct()
    )


def _labelled(rows: DataFrame, labels: DataFrame, *names: str) -> DataFrame:
    """``rows`` with the component of each named id beside it, the id itself without one."""
    for name in names:
        told = labels.select(F.col("id").alias(name), F.col("component").alias("_found"))
        rows = rows.join(told, name, "left")
        rows = rows.withColumn(f"{name}_in", F.coalesce("_found", name)).drop("_found")
    return rows


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: the links are first lifted to components."""
    lifted = _labelled(links, labels, "a", "b").select(F.col("a_in").alias("a"), F.col("b_in").alias("b"))
    merged = components(lifted.where("a != b"))
    moved = _labelled(labels, merged, "component").select("id", F.col("component_in").alias("component"))
    new = merged.join(labels.select("id"), "id", "left_anti")
    return stored(moved.unionByName(new), "labels")


def judged(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``near_duplicates`` with the key of each row's set in ``set_key``.

    The key is null for rows that are linked with nothing. A node is a set with the
    smallest id that holds it, so different texts under one id stay different nodes. Nodes
    are numbered in order of id and key; everything but the texts goes by these numbers.
    """
    linked = F.when(F.col("id").isNotNull(), F.col("set_key"))
    signed = stored(signatures(docs, id, text).withColumn("set_key", linked), "signatures")
    linkable = signed.where("set_key is not null")
    nodes = linkable.groupBy("set_key").agg(F.min("id").alias("id"), F.min_by("bands", "id").alias("bands"))
    # In a sorted table these numbers follow the order; stored, they stay.
    nodes = stored(nodes.orderBy("id", "set_key").withColumn("node", F.monotonically_increasing_id()), "nodes")
    entries = stored(nodes.select(F.col("node").alias("member"), F.explode("bands").alias("band")), "entries")
    stars = stored(_stars(entries, 0), "pairs")
    # Only texts of documents that share a bucket are ever compared.
    involved = stars.select("member").unionByName(stars.select(F.col("center").alias("member"))).distinct()
    involved = nodes.join(involved, F.col("node") == F.col("member")).select("node", "id", "set_key")
    told = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    told = with_set_keys(told.join(involved.select("id").distinct(), "id", "left_semi").select("text"))
    told = told.where("set_key is not null").groupBy("set_key").agg(F.min("text").alias("text"))
    texts = stored(told.join(involved, "set_key").select("node", "text"), "texts")
    closest = F.max_by("center", F.struct("shared", F.xxhash64("center")))
    first = stars.groupBy("member").agg(closest.alias("center"))
    labels = components(_confirmed(first, texts))
    # One link settles most members; the other pairs matter only between components.
    for turn in range(CENTER_ROUNDS + 1):
        pairs = stars if turn == 0 else _stars(entries, turn)
        between = _labelled(pairs, labels, "center", "member").where("center_in != member_in")
        links = stored(_confirmed(between, texts), "links")
        if links.limit(1).count():
            labels = _joined(labels, links)
        entries = stored(_open(entries, turn, labels), "open")
        if not entries.limit(1).count():
            break
    else:
        links = stored(_confirmed(_rare_pairs(entries, texts, labels), texts), "links")
        if links.limit(1).count():
            labels = _joined(labels, links)
    # A set without links is a component of its own.
    named = nodes.select("node", "set_key").join(labels.select(F.col("id").alias("node"), "component"), "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    heads = nodes.select(F.col("node").alias("component"), F.col("id").alias("head_id"), F.col("set_key").alias("head_key"))
    named = named.join(heads, "component").select("set_key", "head_id", "head_key")
    smallest = (F.col("id") == F.col("head_id")) & (F.col("set_key") == F.col("head_key"))
    return signed.join(named, "set_key", "left").select(
        F.col("id").alias(id),
        "n_shingles",
        "set_key",
        F.coalesce("head_id", "id").alias("component_id"),
        F.coalesce(smallest, F.lit(True)).alias("kept"),
    )


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id``, n_shingles, component_id and kept.

    Documents are linked when at least three quarters of their joint shingles are common.
    Those with equal sets are one node from the start, so copies cost no pairs. A text that
    is null or without words has no shingles and is linked with nothing. Rows with a null
    id are linked with nothing either: their component is null and they are kept. Repeated
    rows get equal results; rows that share an id but not the text have the component of
    their own text. ``kept`` marks the smallest id of a component, and of different texts
    under that id in one component the one with the smallest key.
    """
    return judged(docs, id, text).select(id, "n_shingles", "component_id", "kept")
