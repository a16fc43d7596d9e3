"""Conversations from reply trees, with a reversible template and a loss mask.

Self-joins double the reach of every reply's link until it meets its root, adding up scores on the
way; leaves are ranked by the score of their branch; the chosen branches are laid out again by as many
joins. The number of joins is the logarithm of the depth.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwise.llm.arrow import with_python
from stallwise.sources.scratch import materialized

#: The marks of the template.
START, USER, USER_END, STOP, ROLE_END = "<s>", "[INST] ", " [/INST]", " </s>", " </role>"
_TURN = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?) </s>|<role=(?P<role>(?:[^>]|>\\)*)> (?P<other>.*?) </role>", re.S)


def escaped(text: str) -> str:
    """No mark can stand in the result: each "<" and "[" is parted from what follows."""
    return text.replace("<", "<\\").replace("[", "[\\")


def unescaped(text: str) -> str:
    return text.replace("<\\", "<").replace("[\\", "[")


def formatted(roles: list[str], texts: list[str]) -> tuple[str, list[tuple[int, int]]]:
    """One conversation as text, and the spans of code points that are trained on: the assistant's texts."""
    out, at, mask = [START], len(START), []
    for role, text in zip(roles, texts, strict=True):
        body = escaped(text)
        if role == "user":
            before, after = USER, USER_END
        elif role == "assistant":
            before, after = " ", STOP
            mask.append((at + 1, at + 1 + len(body)))
        else:
            before, after = f"<role={escaped(role).replace('>', '>' + chr(92))}> ", ROLE_END
        out += [before, body, after]
        at += len(before) + len(body) + len(after)
    return "".join(out), mask


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out, at = [], len(START)
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        if m["user"] is not None:
            out.append(("user", unescaped(m["user"])))
        elif m["assistant"] is not None:
            out.append(("assistant", unescaped(m["assistant"])))
        else:
            out.append((unescaped(m["role"].replace(">\\", ">")), unescaped(m["other"])))
        at = m.end()
    return out


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, path, place, node) along the best branches of every tree of (tree, node, parent, score).

    A node without parent, or whose parent is not there, is a root. The score of a branch is the sum of
    its nodes', NULL counting 0; equal scores go by the least leaf. Replies in a ring have no root and
    are left out. path is the branch's leaf, place counts from the root.
    """
    nodes = materialized(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0)).cast("double").alias("score")))
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    linked = nodes.join(known, ["tree", "parent"], "left")
    up = F.when(F.col("there"), F.col("parent")).alias("up")
    step = materialized(linked.select("tree", "node", up, F.col("score").alias("total"), F.lit(1).alias("hops")))
    closed = step.filter("up IS NULL")
    jumps: list[DataFrame] = []
    open_ = None
    # only links that have not met their root are joined, and each round writes only those
    while (left := step.filter("up IS NOT NULL").count()) and left != open_:
        open_ = left
        jump = step.filter("up IS NOT NULL")
        jumps.append(jump.select("tree", "node", "up"))
        far = closed.unionByName(jump).select(
            "tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("t2"), F.col("hops").alias("h2")
        )
        total, hops = (F.col("total") + F.col("t2")).alias("total"), (F.col("hops") + F.col("h2")).alias("hops")
        step = materialized(jump.join(far, ["tree", "up"]).select("tree", "node", F.col("up2").alias("up"), total, hops))
        closed = closed.unionByName(step.filter("up IS NULL"))
    parents = nodes.select("tree", F.col("parent").alias("node")).distinct()
    # written first: Spark would anti-join each part of the union on its own
    leaves = materialized(closed).join(parents, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = leaves.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= branches)
    laid = materialized(chosen.select("tree", F.col("node").alias("path"), "node", F.col("hops").alias("place")))
    for k, jump in enumerate(jumps):
        below = laid.filter(F.col("place") > 2**k).join(jump, ["tree", "node"])  # the others have no turn so far above
        higher = below.select("tree", "path", F.col("up").alias("node"), (F.col("place") - 2**k).alias("place"))
        laid = laid.unionByName(materialized(higher))
    return laid


def conversations_of(messages: DataFrame, branches: int = 1) -> DataFrame:
    """tree, path, formatted and mask (start, end) of the best branches of messages with role and text.

    NULL roles and texts are as empty ones. Messages of one tree need distinct nodes.
    """
    paths = chosen_paths(messages, branches)
    said = messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = paths.join(said, ["tree", "node"]).groupBy("tree", "path")
    rows = turns.agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))

    def make():
        def each(roles, texts):
            for r, t in zip(roles, texts, strict=True):
                text, mask = formatted(r, t)
                yield text, [{"start": a, "end": b} for a, b in mask]

        return each

    rows = rows.select("tree", "path", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    return with_python(rows, ["roles", "texts"], "formatted string, mask array<struct<start: int, `end`: int>>", make, drop=["roles", "texts"])


def messages_of(conversations: DataFrame) -> DataFrame:
    """Turns of a table of (conv_id, turn, role, text) as replies, each to the turn before it.

    Rows of equal turn follow by role and text, so repeated rows are turns of their own; NULL turns come first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    d = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order))
    tree = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("none"))
    return d.select(
        tree.alias("tree"),
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        F.length("text").alias("score"),
        "role",
        "text",
        "conv_id",
    )


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the formatted text."""

    def make():
        def each(texts, masks):
            for text, mask in zip(texts, masks, strict=True):
                turns = parsed(text)
                loss = "".join(unescaped(text[s["start"] : s["end"]]) for s in mask)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in (said, loss)]
                yield len(turns), digests[0], len(loss), digests[1], len(text)

        return each

    messages = materialized(messages_of(conversations))
    rows = conversations_of(messages)
    added = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    out = with_python(rows.select("tree", "formatted", "mask"), ["formatted", "mask"], added, make, drop=["formatted", "mask"])
    ids = messages.filter("node = 1").select("tree", "conv_id")
    names = [f.split()[0] for f in added.split(", ")]
    return out.join(ids, "tree").select("conv_id", *names)


ORACLE = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, replace(replace(text, '<', '<\\'), '[', '[\\') AS e,
    CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6
      ELSE 8 + 8 + length(replace(replace(replace(role, '<', '<\\'), '[', '[\\'), '>', '>\\')) END AS marks
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(e) + marks) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
