"""Reply trees as training conversations.

Messages point to the message they answer. Iterative self-joins double the step
along those pointers until every message knows its root, its depth and the score of
the way to it. Leaves are ranked per tree, and each chosen path becomes one text.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import map_batches, stored

OPEN, CLOSE = "<s>", "</s>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ESCAPED = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_MARKED = re.compile(r"\\(.)", re.DOTALL)
TRAINED_ROLE = "assistant"


def escape(text: str) -> str:
    """A text without control strings: a backslash breaks each, and doubles itself."""
    return _ESCAPED.sub(lambda m: m[0][0] + "\\" + m[0][1:] if len(m[0]) > 1 else "\\\\", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of it that are trained on."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    at = 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}\n", escape(text)
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        if not part.startswith(OPEN):
            raise ValueError("a turn without its opening mark")
        role, found, text = part[len(OPEN) :].partition("\n")
        if not found:
            raise ValueError("a turn without a role line")
        turns.append((unescape(role), unescape(text)))
    return turns


def linear_trees(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Messages of plain conversations: each answers the turn before it.

    Turns with equal numbers follow in order of role and text, null first, and all
    stay. Rows without a conversation id form one conversation of their own. Null
    roles and texts are empty. A role is one line: line breaks in it become blanks.
    """
    rows = conversations.select(
        conversations[conv].alias("tree"),
        conversations[turn].alias("turn"),
        F.regexp_replace(F.coalesce(conversations[role], F.lit("")), r"\n", " ").alias("role"),
        F.coalesce(conversations[text], F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    placed = rows.withColumn("message", F.row_number().over(order).cast("long"))
    above = F.when(F.col("message") > 1, F.col("message") - 1)
    return placed.select("tree", "message", above.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def rank_paths(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves with depth, path score and rank in their tree, and the pointer tables.

    Every round joins the pointers with themselves: after k rounds a message points
    2^k answers up. The tables of all rounds are kept to walk chosen paths later.
    """
    keyed = messages.select(
        F.coalesce(F.col("tree").cast("string"), F.lit("")).alias("t"), "message", "parent", "score"
    )
    nodes = stored(
        keyed.select(
            "t", "message", F.col("parent").alias("up"), F.lit(1).cast("long").alias("steps"),
            F.col("score").alias("sum"),
        ),
        "nodes",
    )
    rounds = [nodes]
    while rounds[-1].where("up is not null").limit(1).count():
        here = rounds[-1]
        far = here.select(
            "t", F.col("message").alias("up"), F.col("up").alias("far"),
            F.col("steps").alias("more"), F.col("sum").alias("above"),
        )
        joined = here.join(far, ["t", "up"], "left").select(
            "t", "message", F.col("far").alias("up"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            (F.col("sum") + F.coalesce("above", F.lit(0.0))).alias("sum"),
        )
        rounds.append(stored(joined, "nodes"))
    answered = keyed.where("parent is not null").select("t", F.col("parent").alias("message"))
    leaves = rounds[-1].join(answered.distinct(), ["t", "message"], "left_anti")
    best = Window.partitionBy("t").orderBy(F.desc("sum"), "message")
    return leaves.withColumn("rank", F.row_number().over(best)), rounds[:-1]


def path_members(leaves: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """Every message on the way from each leaf to its root: t, leaf, message, depth."""
    members = leaves.select("t", F.col("message").alias("leaf"), "message", F.col("steps").alias("depth"))
    for k in reversed(range(len(rounds))):
        jump = rounds[k].where("up is not null").select("t", "message", "up")
        higher = members.join(jump, ["t", "message"]).select(
            "t", "leaf", F.col("up").alias("message"), (F.col("depth") - (1 << k)).alias("depth")
        )
        members = members.unionByName(higher)
        if k % 3 == 0:
            members = stored(members, "members")
    return members


def format_conversations(messages: DataFrame, paths: int = 1) -> DataFrame:
    """The best ``paths`` root-to-leaf paths of each tree, each as one formatted text.

    ``messages`` has tree, message, parent, role, text and score; a path's score is the
    sum over its messages, and of equal paths the smaller leaf comes first. Message
    numbers are unique in a tree, parents exist, and a message without a parent is a
    root. Columns: tree, leaf, rank, formatted, and spans, the trained parts as
    (start, end) in characters. An empty input gives no rows.
    """
    messages = stored(messages, "messages")
    leaves, rounds = rank_paths(messages)
    chosen = stored(leaves.where(F.col("rank") <= paths), "chosen")
    members = path_members(chosen, rounds)
    named = F.coalesce(F.col("tree").cast("string"), F.lit(""))
    told = messages.select(named.alias("t"), "message", "role", "text", "tree")
    gathered = (
        members.join(told, ["t", "message"])
        .groupBy("t", "leaf")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"), F.first("tree").alias("tree"))
        .join(chosen.select("t", F.col("message").alias("leaf"), "rank"), ["t", "leaf"])
        .select("tree", "leaf", "rank", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    )
    kind = gathered.schema["tree"].dataType.simpleString()

    def formatted(batch: pa.RecordBatch) -> pa.RecordBatch:
        turns = zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())
        done = [format_turns(list(zip(*pair))) for pair in turns]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        spans = [[{"start": a, "end": b} for a, b in found] for _, found in done]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([t for t, _ in done], pa.string()), pa.array(spans, span)],
            names=["tree", "leaf", "rank", "formatted", "spans"],
        )

    schema = f"tree {kind}, leaf long, rank int, formatted string, spans array<struct<start:long,end:long>>"
    return map_batches(gathered, formatted, schema)


def read_back(conversations: DataFrame) -> DataFrame:
    """Digests of what formatted conversations hold, read from their text and spans."""
    kind = conversations.schema["tree"].dataType.simpleString()
    import hashlib

    def digest(formatted: str, spans: list[dict]) -> tuple:
        turns = read_turns(formatted)
        loss = "".join(unescape(formatted[s["start"] : s["end"]]) for s in spans)
        told = "".join(f"{role}\n{text}\n" for role, text in turns)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        return len(turns), sha(told), len(loss), sha(loss), len(formatted)

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        columns = list(zip(*(digest(*pair) for pair in pairs)))
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )

    schema = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long"
    )
    return map_batches(conversations.select("tree", "formatted", "spans"), read, schema)
