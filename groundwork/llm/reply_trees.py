"""Chat formatting of reply trees.

Messages point at the message they reply to. Root-to-leaf paths are enumerated by self-joins that double their reach: after j rounds every
message knows its ancestor 2^j steps up and the sum of scores on the way, so a path of d messages takes log2(d) rounds. Leaves
are then ranked within their tree by the mean score of their path, and the messages of the chosen paths are found by walking the same
doubling tables down from the leaves. Each chosen path is formatted as one conversation.

The template marks turns and escapes control strings inside roles and texts: a backslash goes before every backslash and closing bracket and before the
first character of <s>, </s>, [INST and [/INST, so a text can never open or close a turn, and reading back gives the text exactly.

Null texts count as empty; null roles count as the empty role. A message whose parent is missing is a root. Messages in a cycle have no
root and give no path. Of messages that repeat an id within a tree, all rows are joined as they stand in the conversation
interface below, where turns are numbered by (turn, role, text) and ties keep every row. An empty table gives no rows. A conversation is
one value, as its formatted text is, so it stands whole in one task.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundwork.llm.common import staged

#: A turn is OPEN role BODY text CLOSE.
OPEN, BODY, CLOSE = "[INST:", "]", "</s>"
_CONTROL = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST)|\]")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and the spans (start, end) of it that bear loss: the assistant's escaped texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{BODY}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans


def unescaped_at(formatted: str, mark: str, at: int) -> int:
    """Where the first `mark` from `at` on stands that no backslash escapes."""
    while (found := formatted.find(mark, at)) >= 0:
        before = found
        while before > at and formatted[before - 1] == "\\":
            before -= 1
        if (found - before) % 2 == 0:
            return found
        at = found + 1
    raise ValueError(f"no {mark} from {at} on")


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        body = unescaped_at(formatted, BODY, at + len(OPEN))
        close = unescaped_at(formatted, CLOSE, body + len(BODY))
        turns.append((unescape(formatted[at + len(OPEN) : body]), unescape(formatted[body + len(BODY) : close])))
        at = close + len(CLOSE)
    return turns


def paths(messages: DataFrame, most_rounds: int = 40) -> DataFrame:
    """tree, leaf, depth (messages), score (mean) and branch_rank of each root-to-leaf path of messages(tree, node, parent, score).

    Rank 1 is the best mean score, ties go to the smaller leaf.
    """
    return _ranked(_jumps(messages, most_rounds)[0], messages)


def _jumps(messages: DataFrame, most_rounds: int) -> tuple[DataFrame, list[DataFrame]]:
    """Every message's way to the root (tree, node, up, steps, total; up null unless it is in a cycle), and per round j the messages that have one 2^j above, up.

    Only messages that have not reached their root take part in a round.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there")).distinct()
    first = nodes.join(known, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there"), F.col("parent")).alias("up"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("total"))
    now, climbing = staged(first, "jumps"), []
    for _ in range(most_rounds):
        live = now.where("up IS NOT NULL")
        if not live.take(1):
            break
        climbing.append(live.select("tree", "node", "up"))
        far = now.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"), F.col("total").alias("total2"))
        moved = live.join(far, ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"), (F.col("total") + F.col("total2")).alias("total"))
        now = staged(moved.union(now.where("up IS NULL")), "jumps")
    return now, climbing


def _ranked(top: DataFrame, messages: DataFrame) -> DataFrame:
    parents = messages.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = top.where("up IS NULL").join(parents, ["tree", "node"], "left_anti")
    scored = leaves.select("tree", F.col("node").alias("leaf"), F.col("steps").alias("depth"), (F.col("total") / F.col("steps")).alias("score"))
    return scored.withColumn("branch_rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))


def chosen_messages(messages: DataFrame, best: int = 1, most_rounds: int = 40) -> DataFrame:
    """tree, leaf, branch_rank, turn (from 0), node: the messages of each tree's `best` paths of messages(tree, node, parent, score)."""
    ways, climbing = _jumps(messages, most_rounds)
    chosen = _ranked(ways, messages).where(F.col("branch_rank") <= best)
    reached = staged(chosen.select("tree", "leaf", "branch_rank", F.col("leaf").alias("node"), (F.col("depth") - 1).alias("turn")), "path")
    for j in range(len(climbing) - 1, -1, -2):  # each message also gives the ones 2^j, 2^(j - 1) and both of these above it, so that two rounds' ways are gone in one
        ways = climbing[j].select("tree", "node", "up", F.lit(1 << j).alias("far"))
        if j:
            half = climbing[j - 1].select("tree", "node", "up", F.lit(1 << j - 1).alias("far"))
            both = ways.join(half.select("tree", F.col("node").alias("up"), F.col("up").alias("up2")), ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), F.lit((1 << j) + (1 << j - 1)).alias("far"))
            ways = ways.union(half).union(both)
        above = reached.join(ways, ["tree", "node"]).select("tree", "leaf", "branch_rank", F.col("up").alias("node"), (F.col("turn") - F.col("far")).alias("turn"))
        reached = staged(reached.union(above), "path")
    return reached.distinct()


def format_paths(turns: DataFrame, key: tuple[str, ...], role_col: str = "role", text_col: str = "text", turn_col: str = "turn") -> DataFrame:
    """One row per path: key columns, formatted, and loss_spans (start and end in code points of formatted)."""
    gathered = turns.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))).alias("turns"))
    shaped = gathered.select(*key, F.transform("turns", lambda t: t["role"]).alias("__roles"), F.transform("turns", lambda t: t["text"]).alias("__texts"))
    out = gathered.select(*key).withColumns({"formatted": F.lit(""), "loss_spans": F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end")))}).schema
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            k = batch.num_columns - 2
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                done = [format_turns(list(zip(r, t, strict=True))) for r, t in zip(part.column(k).to_pylist(), part.column(k + 1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(k)), pa.array([f for f, _ in done], pa.string()), pa.array([[{"start": a, "end": b} for a, b in s] for _, s in done], spans)], names=[*key, "formatted", "loss_spans"])

    return shaped.mapInArrow(run, out)


def read_back(formatted: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """What formatted strings hold: key columns, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    out = formatted.select(*key).withColumns({"n_turns": F.lit(0).cast("long"), "turns_sha256": F.lit(""), "loss_chars": F.lit(0).cast("long"), "loss_sha256": F.lit(""), "formatted_chars": F.lit(0).cast("long")}).schema

    def run(batches):
        for batch in batches:
            k, rows = batch.num_columns - 2, []
            for text, spans in zip(batch.column(k).to_pylist(), batch.column(k + 1).to_pylist(), strict=True):
                turns = hashlib.sha256()
                found = read_turns(text)
                for role, body in found:
                    turns.update(f"{role}\n{body}\n".encode())
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                rows.append((len(found), turns.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(k)), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=[*key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select(*key, "formatted", "loss_spans").mapInArrow(run, out)


def conversations_as_trees(rows: DataFrame) -> DataFrame:
    """Messages of conv_id, turn, role, text rows as trees of one branch: a row replies to the row before it in (turn, role, text) order."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).withColumn("node", F.row_number().over(order).cast("long"))
    return numbered.select(F.struct("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")
