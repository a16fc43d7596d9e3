"""Cheapest repair of damaged conversations, by iterative-deepening A*.

A repaired conversation is an optional system turn and then user and assistant in turn, ending with the
assistant. Rows are kept (cost 0), given the other role (2) or deleted (3, which blank rows and duplicates
have to be), and empty turns are inserted (2); a row cut short that stays costs 1. The search goes depth
first through the edits in ASCII order under a bound on the cost, and the bound grows by the least excess
that the last round met. The rest of a path is never taken for dearer than it is (``bounds``). A table holds for each state the most budget that failed from it, over all rounds, so
no state is tried again with as little. As edits go in ASCII order, the first path that arrives within the
least bound is the answer.

A long conversation is cut into pieces of ``PIECE`` rows, which are searched by tasks of their own, from
every state to every state; the pieces' answers are then joined in order. That gives the same answer: the
edits of a piece end with one on its last row, so none is the beginning of another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stallwise.llm.arrow import with_python
from stallwise.sources.scratch import materialized

PIECE = 512
RETITLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: States: nothing said yet, after system, after user, after assistant. What a role's initial leads to.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The state after a turn of the role that an edit may write: the user's, or the assistant's after a user.
_MADE = (2, 2, 3, 2)
#: The pairs of initials that are legal.
_LEGAL = ("su", "ua", "au")
ROLES = {2: "user", 3: "assistant"}
#: A row's code is its role's initial, or "?" for none of the three, and its fault: these.
SOUND, BLANK, DUPLICATE, CUT_SHORT = ".", "b", "d", "t"


def bounds(codes: str) -> list[int]:
    """For each row, a cost that no repair of what begins there is under.

    Besides forced deletions and cut rows: 2 for each row that is neither the user's nor the assistant's, as at
    most one of them, a system turn, can stay; and 1 wherever two rows that are do not fit the number of others between
    them. A new role or a deletion costs 2 or more and mends two such places at most, an inserted turn one,
    and one of the others costs 1 more to delete than to rename; nothing more if cut, so that place does not count.
    """
    out = [0] * (len(codes) // 2 + 1)
    total, ahead, odd, free, system = 0, "", False, False, False
    for i in range(len(out) - 2, -1, -1):
        role, fault = codes[2 * i], codes[2 * i + 1]
        cut = fault == CUT_SHORT
        if fault in (BLANK, DUPLICATE):
            total += DELETE
        elif role in "ua":
            total += (CUT if cut else 0) + (ahead != "" and not free and (role == ahead) != odd)
            ahead, odd, free = role, False, False
        else:
            total += RETITLE + (CUT if cut else 0)
            odd, free, system = not odd, free or cut, system or role == "s"
        out[i] = total - (RETITLE if system else 0)
    return out


def cheapest(codes: str, start: int = 0, goal: int | None = None) -> tuple[int, str] | None:
    """(cost, edits) of the best repair of rows from a state to a state; None if there is none.

    ``goal`` None takes an end that is accepted, with turns inserted after the last row if need be.
    Edits are K, R, D and I; of equal costs the least in ASCII order is given.
    """
    n = len(codes) // 2
    least = bounds(codes)
    failed = [-1] * (4 * (n + 1))
    bound = least[0]
    most = DELETE * n + 2 * INSERT * (n + 1)  # all deleted, with two turns between at every place, is no cheaper
    while bound <= most:
        excess = most + 1
        # a frame is row, state, budget left, and the edits still to try from there
        path: list[str] = []
        frames = [(0, start, bound, _choices(codes, n, 0, start, goal))]
        while frames:
            i, state, left, choices = frames[-1]
            if i == n and (state == goal if goal is not None else state in (0, 3)):
                return bound - left, "".join(path)
            step = next(choices, None)
            if step is None:
                failed[4 * i + state] = max(failed[4 * i + state], left)
                frames.pop()
                if path:
                    path.pop()
                continue
            edit, j, after, cost = step
            short = cost + least[j] - left
            if short > 0:
                excess = min(excess, short)
            elif failed[4 * j + after] < left - cost:
                path.append(edit)
                frames.append((j, after, left - cost, _choices(codes, n, j, after, goal)))
            else:  # failed already, and not by less than one
                excess = min(excess, 1)
        bound += excess
    return None


def _choices(codes: str, n: int, i: int, state: int, goal: int | None) -> Iterator[tuple[str, int, int, int]]:
    """(edit, row, state, cost) of every edit at a row, in ASCII order."""
    if i < n:
        role, fault = codes[2 * i], codes[2 * i + 1]
        yield "D", i + 1, state, DELETE
    if i < n or goal is None:
        yield "I", i, _MADE[state], INSERT
    if i < n and fault not in (BLANK, DUPLICATE):
        more = CUT if fault == CUT_SHORT else 0
        if (state, role) in _NEXT:
            yield "K", i + 1, _NEXT[state, role], more
        yield "R", i + 1, _MADE[state], RETITLE + more


def nothing_said(codes: str, start: int, goal: int) -> tuple[int, str] | None:
    """(cost, edits) to end before any user's turn: all rows go but for a system turn, the last of the cheapest."""
    n = len(codes) // 2
    if start == goal:
        return DELETE * n, "D" * n
    for fault, more in ((SOUND, 0), (CUT_SHORT, CUT)) if (start, goal) == (0, 1) else ():
        stays = max((i for i in range(n) if codes[2 * i : 2 * i + 2] == "s" + fault), default=-1)
        if stays >= 0:
            return DELETE * (n - 1) + more, "D" * stays + "K" + "D" * (n - 1 - stays)
    return None


def piece_answers(codes: str, first: bool, last: bool) -> list[dict]:
    """The answers of one piece from every state it may begin in to every state it may end in."""
    out = []
    for start in (0,) if first else range(4):
        for goal in (None,) if last else range(4):
            found = nothing_said(codes, start, goal) if goal in (0, 1) else cheapest(codes, start, goal)
            if found:
                out.append({"start": start, "goal": -1 if goal is None else goal, "cost": found[0], "edits": found[1]})
    return out


def joined(pieces: list[list[dict]]) -> tuple[int, str]:
    """The best way through all pieces, in order."""
    best: dict[int, tuple[int, str]] = {0: (0, "")}
    for answers in pieces:
        ahead: dict[int, tuple[int, str]] = {}
        for a in answers:
            if a["start"] in best:
                cost, edits = best[a["start"]]
                new = cost + a["cost"], edits + a["edits"]
                ahead[a["goal"]] = min(ahead.get(a["goal"], new), new)
        best = ahead
    return best[-1]


def repaired_turns(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, from the edits and the rows in order."""
    state = 0
    for edit in audit:
        if edit == "I":
            state = _MADE[state]
            yield ROLES[state], ""
            continue
        role, text = next(rows)
        if edit == "D":
            continue
        state = _MADE[state] if edit == "R" else _NEXT[state, role[:1]]
        yield (ROLES[state] if edit == "R" else role), text


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the rows with the faults that crc32 of "conv_id:turn" deals them.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 takes its full stops, exclamation and question marks, 3
    repeats it and 4 makes it the user's. NULL role and text become one space, and so do NULL ids and turns where the
    remainder is taken.
    """
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    way = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")) % 20
    d = conversations.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), way.alias("way")).filter("way != 0")
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("way") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def coded(rows: DataFrame) -> DataFrame:
    """Add pos, the place in the conversation (by turn, NULLs first, then role and text), and code, role and fault."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # by the same exchange as the places
    again = Window.partitionBy("conv_id", "role", "text").orderBy("pos")
    d = rows.withColumn("pos", F.row_number().over(order).cast("long") - 1).withColumn("nth", F.row_number().over(again))
    end = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(end == "", BLANK).when(F.col("nth") > 1, DUPLICATE).when(~end.isin(".", "!", "?"), CUT_SHORT).otherwise(SOUND)
    initial = F.substring("role", 1, 1)
    return d.select("*", F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("?"), fault).alias("code")).drop("nth")


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, codes' counts, cost, audit) of every conversation of ``coded`` rows."""
    piece = F.floor(F.col("pos") / PIECE)
    row = F.array_sort(F.collect_list(F.struct("pos", "code")))  # PIECE rows at most
    pieces = rows.groupBy("conv_id", piece.alias("piece")).agg(F.array_join(F.transform(row, lambda r: r["code"]), "").alias("codes"))
    whole = rows.groupBy("conv_id").agg(
        F.floor(F.max("pos") / PIECE).alias("last"),
        *[F.count(F.when(F.substring("code", 2, 1) == fault, 1)).alias(name) for name, fault in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", CUT_SHORT))],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
    )
    whole = materialized(whole)
    pieces = pieces.join(whole.select(F.col("conv_id").alias("__conv"), "last"), F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")

    def search():
        return lambda codes, places, lasts: ((piece_answers(c, p == 0, p == z),) for c, p, z in zip(codes, places, lasts, strict=True))

    answers = "answers array<struct<start: int, goal: int, cost: bigint, edits: string>>"
    found = with_python(pieces, ["codes", "piece", "last"], answers, search, drop=["last"])
    found = found.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "codes", "answers"))).alias("pieces"))

    def join():
        def each(all_pieces):
            for pieces in all_pieces:
                initials = "".join(p["codes"][::2] for p in pieces)
                illegal = sum(initials[k : k + 2] not in _LEGAL for k in range(len(initials) - 1))
                yield (illegal, *joined([p["answers"] for p in pieces]))

        return each

    found = with_python(found, ["pieces"], "illegal bigint, cost bigint, audit string", join, drop=["pieces"])
    found = found.withColumnRenamed("conv_id", "__conv").join(whole.drop("last"), F.col("__conv").eqNullSafe(F.col("conv_id"))).drop("__conv")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Add repaired_sha256 to ``found``: of "role:text" of the repaired turns, with line feeds between.

    A digest takes its text in order, so a conversation's rows pass one task as a sorted stream, behind its edits;
    the task holds the edits and one row.
    """
    none = F.lit(None).cast("string")
    said = rows.select("conv_id", "pos", "role", "text", none.alias("audit"))
    first = found.select("conv_id", F.lit(-1).cast("long").alias("pos"), none.alias("role"), none.alias("text"), "audit")
    stream = first.unionByName(said).repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    kind = found.schema["conv_id"].dataType
    arrow_kind = to_arrow_type(kind)

    def turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                yield from zip(*(part.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        digests: list[str] = []
        rows_ = turns_of(batches)
        for conv, _, _, audit in rows_:
            if audit is None:  # a deleted row after the last turn written
                continue
            digest, between = hashlib.sha256(), b""
            for role, text in repaired_turns(audit, ((r[1], r[2]) for r in rows_)):
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            ids.append(conv)
            digests.append(digest.hexdigest())
            if len(ids) == 4096:
                yield pa.RecordBatch.from_pydict({"__conv": pa.array(ids, arrow_kind), "repaired_sha256": pa.array(digests, pa.string())})
                ids, digests = [], []
        yield pa.RecordBatch.from_pydict({"__conv": pa.array(ids, arrow_kind), "repaired_sha256": pa.array(digests, pa.string())})

    done = stream.mapInArrow(run, f"__conv {kind.simpleString()}, repaired_sha256 string")
    return found.join(done, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")


def repairs(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for every conv_id of ``conversations``, the repair of its ``rows`` (conv_id, turn, role, text).

    gaps, blank, duplicate, truncated, illegal, cost and audit, and the digest of the repaired conversation. A NULL
    conv_id is a conversation; NULL turns come first and are in no gap; rows of one turn go by role and text, so of
    repeated rows all but one are duplicates. A conversation without rows has zeros, no edits and the digest of the
    empty string. Roles other than system, user and assistant cannot stay unless their first letter is one of
    theirs. Texts of any length are taken whole; further columns play no part; an empty table gives no rows.
    """
    rows = materialized(coded(rows.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])))
    found = repaired_digests(rows, materialized(audits(rows)))
    known = conversations.select(F.col("conv_id").alias("__conv")).distinct()
    out = known.join(found, F.col("__conv").eqNullSafe(F.col("conv_id")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return out.select(F.col("__conv").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def damaged_repairs(conversations: DataFrame) -> DataFrame:
    """``repairs`` of ``damaged`` conversations."""
    return repairs(conversations, damaged(conversations))


ORACLE = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda s: CAST(ascii(s) AS BIGINT))),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [CAST(0 AS BIGINT) FOR k IN range(8)]),
        lambda x, k: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1))))) % 20 AS way
  FROM conversations),
d AS (
  SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
    CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE way WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM c WHERE way <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS ending
  FROM d),
f AS (
  SELECT conv_id, pos, turn, role, text, role[1:1] AS i, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
    CASE WHEN ending = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd' WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
  FROM o),
w AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM f GROUP BY conv_id),
lead AS (SELECT * FROM (VALUES
  (0, 0, '', 0, []), (0, 2, 'I', 2, ['user:']), (0, 3, 'II', 4, ['user:', 'assistant:']),
  (1, 1, '', 0, []), (1, 2, 'I', 2, ['user:']), (1, 3, 'II', 4, ['user:', 'assistant:']),
  (2, 2, '', 0, []), (2, 3, 'I', 2, ['assistant:']), (2, 2, 'II', 4, ['assistant:', 'user:']),
  (3, 3, '', 0, []), (3, 2, 'I', 2, ['user:']), (3, 3, 'II', 4, ['user:', 'assistant:'])) AS x(a, b, ins, cost, said)),
s(conv_id, pos, st, best) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {'c': CAST(0 AS BIGINT), 'a': '', 'o': CAST([] AS VARCHAR[])} FROM w
  UNION ALL
  SELECT s.conv_id, f.pos, m.st, min({'c': s.best.c + lead.cost + m.cost, 'a': s.best.a || lead.ins || m.edit, 'o': s.best.o || lead.said || m.said})
  FROM s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.pos = s.pos + 1 JOIN lead ON lead.a = s.st,
  LATERAL (
    SELECT unnest([
      {'st': lead.b, 'edit': 'D', 'cost': 3, 'ok': true, 'said': CAST([] AS VARCHAR[])},
      {'st': CASE lead.b WHEN 2 THEN 3 ELSE 2 END, 'edit': 'R', 'cost': 2 + CAST(f.fault = 't' AS INT), 'ok': f.fault IN ('', 't'),
       'said': [CASE lead.b WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || f.text]},
      {'st': CASE f.i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'edit': 'K', 'cost': CAST(f.fault = 't' AS INT),
       'ok': f.fault IN ('', 't') AND (f.i = 's' AND lead.b = 0 OR f.i = 'u' AND lead.b <> 2 OR f.i = 'a' AND lead.b = 2),
       'said': [f.role || ':' || f.text]}], recursive := true)) AS m
  WHERE m.ok
  GROUP BY s.conv_id, f.pos, m.st),
e AS (
  SELECT s.conv_id, min({'c': s.best.c + t.cost, 'a': s.best.a || t.ins, 'o': s.best.o || t.said}) AS best
  FROM s JOIN w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.pos = w.n
  JOIN lead AS t ON t.a = s.st AND (t.b = 3 AND t.cost <= 4 OR t.a = 0 AND t.b = 0)
  GROUP BY s.conv_id)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.best.c, 0) AS cost, coalesce(e.best.a, '') AS audit,
  sha256(coalesce(array_to_string(e.best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS k
LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM k.conv_id
"""
