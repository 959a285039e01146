r"""Reply trees to chat texts.

Messages ``(tree, message, parent, role, text, score)`` form one tree or more per ``tree``. Root-to-leaf paths are found by
iterative self-joins that double the distance each round: after round k every message knows its ancestor 2^k steps
up and the score gathered on the way, so a reply chain of n turns takes log2(n) joins, not n. A branch's rank within its tree is
its total score (ties: smaller leaf id). The ancestors of each chosen leaf are then listed by the same pointers, every row exactly
once. Each round is a written table: a lost executor repeats one round's tasks, and the joins of plain tables are split by AQE
when one root has a third of all messages as children.

Format of a turn: ``<|im_start|>role\ntext<|im_end|>\n``. Inside role and text every backslash is doubled and every control string
(of this template and the other usual ones) gets a backslash after its first character, so none is left whole;
``\\(.)`` -> ``\1`` undoes it. In a role a line end is written ``\n``. A conversation is a sequence of such pieces, one per turn; its
text is their concatenation and is never gathered in one row, so its length has no bound. ``loss_start``/``loss_end`` mark, in
code points of the piece, the assistant's text.

Edge cases: null texts and roles are empty; a message whose parent is unknown is a root; messages in a cycle have no root and no
path; of repeated message ids the smallest ``(parent, role, text)`` counts; null scores are 0; a null tree id is a tree of its own; an empty
table has no path; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm.common import discard, is_empty, materialize
from urbanlens.operators.ordering import numbered

#: Strings with a meaning in some chat template.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_INNER = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)
PIECE = "tree string, conv_id long, branch int, leaf long, seq long, piece string, loss_start int, loss_end int"


def escape(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\\", r"\\\\"), f"({_INNER})", r"$1\\")


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", r"\1", s, flags=re.S)


def unescape_role(s: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], s, flags=re.S)


def chains(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as trees: every turn answers the one before; equal turn numbers go by role and text.

    Turns are numbered by a range partition with prefix sums: no conversation is sorted in one task.
    """
    rows = rows.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    rows = rows.withColumn("tree", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))
    rows = numbered(rows, ["tree"], *(F.col(c).asc_nulls_first() for c in ("turn", "role", "text")), name="message")
    return rows.select("tree", "conv_id", "message", F.expr("nullif(message - 1, 0)").alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def chosen_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """``tree, branch, leaf, message, seq`` of the ``branches`` best leaves of each tree (None: all).

    ``nodes``: a plain table ``tree, message, parent, score`` with one row per message and no unknown parents.
    """
    first = nodes.select("tree", "message", F.col("parent").alias("up"), F.lit(1).cast("long").alias("steps"),
                         F.when(F.col("parent").isNotNull(), F.col("score")).otherwise(0.0).alias("gain"))
    rounds = [materialize(first, "chat-jump")]  # gain: the scores of the steps nearest messages, itself included
    ended = nodes.filter("parent is null").select("tree", "message", F.lit(0).cast("long").alias("depth"), F.col("score").alias("total"))
    done = [materialize(ended, "chat-ended")]
    while True:
        last = rounds[-1]
        live = last.filter("up is not null")
        if is_empty(live):
            break
        # every message below a finished one at this distance is finished too
        k = 1 << (len(rounds) - 1)
        finished = done[-1] if len(done) == 1 else _union(done)
        reached = live.join(finished.select(F.col("tree"), F.col("message").alias("up"), "depth", "total"), ["tree", "up"]).select(
            "tree", "message", (F.col("depth") + k).alias("depth"), (F.col("gain") + F.col("total")).alias("total"))
        reached = materialize(reached, "chat-ended")
        if is_empty(reached):
            break  # only cycles are left
        done.append(reached)
        up = last.select("tree", F.col("message").alias("up"), F.col("up").alias("up2"), F.col("gain").alias("gain2"))
        rounds.append(materialize(live.join(up, ["tree", "up"], "left").select(
            "tree", "message", F.col("up2").alias("up"), F.lit(2 * k).cast("long").alias("steps"),
            (F.col("gain") + F.col("gain2")).alias("gain")), "chat-jump"))
    parents = nodes.filter("parent is not null").select("tree", F.col("parent").alias("message")).distinct()
    leaves = _union(done).join(parents, ["tree", "message"], "left_anti")
    if branches is not None:
        best = Window.partitionBy("tree").orderBy(F.desc("total"), "message")
        leaves = leaves.withColumn("branch", F.row_number().over(best)).filter(F.col("branch") <= branches)
    else:
        leaves = leaves.withColumn("branch", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "message")))
    path = leaves.select("tree", "branch", F.col("message").alias("leaf"), "message", F.col("depth").alias("seq"))
    path = materialize(path, "chat-path")
    for k, jump in reversed(list(enumerate(rounds))):
        up = jump.filter("up is not null").select("tree", "message", "up")
        step = path.join(up, ["tree", "message"], "left").select(
            "tree", "branch", "leaf", F.explode(F.array(
                F.struct("message", "seq"), F.struct(F.col("up").alias("message"), (F.col("seq") - (1 << k)).alias("seq")))).alias("at"))
        step = step.filter("at.message is not null").select("tree", "branch", "leaf", "at.message", "at.seq")
        longer = materialize(step, "chat-path")
        discard(path)
        path = longer
    for t in [*rounds, *done]:
        discard(t)
    return path


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """The formatted pieces, ``PIECE``, of the chosen branches of every tree.

    ``messages``: ``tree, conv_id, message, parent, role, text, score``.
    """
    kept = messages.groupBy("tree", "message").agg(F.min(F.struct("parent", "role", "text", "conv_id", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m"))
    kept = materialize(kept.select("tree", "message", "m.*"), "chat-messages")
    known = kept.select("tree", F.col("message").alias("parent"), F.lit(True).alias("known"))
    nodes = kept.select("tree", "message", "parent", "score").join(known, ["tree", "parent"], "left").select(
        "tree", "message", F.when(F.col("known"), F.col("parent")).alias("parent"), "score")
    path = chosen_paths(materialize(nodes, "chat-nodes"), branches)
    role = F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit("<|im_start|>"), role, F.lit("\n"))
    body = escape(F.col("text"))
    loss = F.col("role") == "assistant"
    return path.join(kept, ["tree", "message"]).select(
        "tree", "conv_id", "branch", "leaf", "seq", F.concat(head, body, F.lit("<|im_end|>\n")).alias("piece"),
        F.when(loss, F.length(head)).alias("loss_start"), F.when(loss, F.length(head) + F.length(body)).alias("loss_end"))


def read_conversations(pieces: DataFrame) -> DataFrame:
    """Parse the formatted text back: one row per conversation, from the text and its loss mask alone.

    Pieces arrive sorted by conversation and sequence number, and digests are kept open from piece to piece: the memory needed is
    that of one piece, however long a conversation is.
    """
    shards = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.repartition(shards, "tree", "branch").sortWithinPartitions("tree", "branch", "seq")
    turn = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, rows = None, None, []

        def close():
            conv, branch, n, turns, chars, loss, formatted = state
            rows.append((conv, branch, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

        for frame in frames:
            frame = frame.astype(object).where(frame.notna(), None)
            for r in frame.itertuples(index=False):
                if (r.tree, r.branch) != key:
                    if state:
                        close()
                    key, state = (r.tree, r.branch), [r.conv_id, r.branch, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                m = turn.fullmatch(r.piece)
                if not m:
                    raise ValueError(f"not a turn: {r.piece[:80]!r}")
                state[2] += 1
                state[3].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                if r.loss_start is not None:
                    learnt = unescape(r.piece[int(r.loss_start):int(r.loss_end)])
                    state[4] += len(learnt)
                    state[5].update(learnt.encode("utf-8", "surrogatepass"))
                state[6] += len(r.piece)
            if len(rows) > 1000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        if state:
            close()
        yield pd.DataFrame(rows, columns=names)

    schema = "conv_id long, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [f.split()[0] for f in schema.split(", ")]
    return dealt.select("tree", "conv_id", "branch", "seq", "piece", "loss_start", "loss_end").mapInPandas(read, schema)
