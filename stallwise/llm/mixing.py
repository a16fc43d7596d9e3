"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is the number of copies that each of its documents should have. The whole
part is taken at once; the fractional parts are rounded in pairs: of two documents with a fractional
probability one gives words to the other until one of the two is taken whole or not at all. Which one gives is
drawn so that no document's probability changes in expectation, and the words expected of the
source stay the same with each pair, so what a source gives in the end differs from its target by half of
the last document at most.

Pairs are rounded in blocks of ``BLOCK`` documents of a source, by tasks of their own. A block leaves one
document at most that is still fractional, and these residuals are dealt to blocks again, level after level,
until a source has one left, which is rounded to the nearer end. A document that is large among those after it is
paired with all of them at once, so that what is left last is small. All draws are hashes of the document and the level, so a rerun draws the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import with_python
from stallwise.sources.scratch import materialized

#: The weights of the sources in order, repeating, and the most copies of a document.
WEIGHTS, MOST_COPIES = (5, 2, 1), 3
BLOCK = 4096
#: A document is paired with all that come after it if it has more than this part of their words.
GIANT = 32
#: Rows that one task lists at a time of rows that are alike in all.
ALIKE = 1 << 16
#: Shares nearer to none or all than this are whole: rounding errors of doubles.
EPSILON = 1e-9


def sizes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the words of each whole text, which white space parts; NULL has none."""

    def make():
        return lambda texts: ((len((t or "").encode("utf-8").split()),) for t in texts)

    d = docs.select("doc_id", "source", F.col("text").alias("__text"))
    return with_python(d, ["__text"], "size bigint", make, drop=["__text"])


def ranked(sources: DataFrame) -> DataFrame:
    """Add rank, from 0 in code point order, NULL last. Each task numbers its range of the order."""
    d = sources.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    d = materialized(d.withColumn("__id", F.monotonically_increasing_id()))  # task and place in it
    task, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    before, start = 0, {}
    for row in d.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect():  # a row for each task
        start[row["task"]] = before
        before += row["n"]
    if not start:
        return d.withColumn("rank", F.lit(0).cast("long")).drop("__id")
    offset = F.create_map(*[F.lit(x).cast("long") for item in start.items() for x in item])
    return d.withColumn("rank", offset[task] + place).drop("__id")


def targets(sources: DataFrame) -> DataFrame:
    """Add target to (source, source_size): the words that each source gives.

    Sources of ``WEIGHTS`` by rank share the sum of all sizes; none gives more than MOST_COPIES times its size, and
    what that leaves is shared among the others by weight. Rounds of one aggregate find the sources that
    are full; a source once full stays so.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    d = materialized(ranked(sources).select("source", "source_size", weight.alias("weight")))
    most = MOST_COPIES * F.col("source_size")
    level, full = None, -1
    while True:
        is_full = F.lit(False) if level is None else most <= F.lit(level) * F.col("weight")
        r = d.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(is_full, most).otherwise(0)).alias("taken"),
            F.sum(F.when(is_full, 0).otherwise(F.col("weight"))).alias("weights"),
            F.count(F.when(is_full, 1)).alias("full"),
        ).first()
        if not r["weights"] or r["full"] == full:
            break
        level, full = (r["total"] - r["taken"]) / r["weights"], r["full"]
    share = F.lit(0.0 if level is None else float(level)) * F.col("weight")
    return d.select("source", "source_size", F.least(most.cast("double"), share).alias("target"))


def drawn(level: int, *columns: str) -> Column:
    """A number in [0, 1) that is a hash of the columns and the level."""
    return F.shiftrightunsigned(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns], F.lit(level)), 11) / F.lit(float(1 << 53))


def settled(share: np.ndarray) -> np.ndarray:
    """Shares next to none or all as none or all."""
    return np.where((share < EPSILON) | (share > 1 - EPSILON), np.round(share), share)


def pivoted(size: np.ndarray, share: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """The shares after all pairs, and the place of the one that is fractional still, or -1; the largest sizes come first.

    In each pair the words size * share stay the same in sum, and each share in expectation. A document of
    more than a part of ``GIANT`` of what comes after it is paired with all of that as one.
    """
    share = settled(share)
    after = np.cumsum(size[::-1])[::-1] - size
    for k in np.flatnonzero(np.cumsum(GIANT * size <= after) == 0):
        pool = k + 1 + np.flatnonzero((share[k + 1 :] > 0) & (share[k + 1 :] < 1))
        if not 0 < share[k] < 1 or not len(pool):
            continue
        a, b = size[k], size[pool].sum()
        up, down = min(a * (1 - share[k]), b * share[pool].min()), min(a * share[k], b * (1 - share[pool].max()))
        moved = up if draw[k] * 2**26 % 1 * (up + down) < down else -down
        share[k] += moved / a
        share[pool] -= moved / b
        share = settled(share)
    held = -1
    for k in np.flatnonzero((share > 0) & (share < 1)).tolist():
        if held >= 0:
            a, b = size[held], size[k]
            x, y = a * share[held], b * share[k]
            up, down = min(a - x, y), min(x, b - y)  # what the held one may get, and give
            moved = up if draw[k] * (up + down) < down else -down
            share[[held, k]] = settled(np.array([(x + moved) / a, (y - moved) / b]))
        if held < 0 or not 0 < share[held] < 1:
            held = k
        if not 0 < share[held] < 1:
            held = -1
    return share, held


def rounded(units: DataFrame, level: int) -> DataFrame:
    """``units`` after one level: share and more, whether the unit is fractional still, and copies if it is not."""
    n = units.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    # written, so that its size is known and the rows of a hot source may be split
    n = materialized(n.withColumnRenamed("source", "__source"))
    d = units.join(n, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    key = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("doc_id", "size")]
    d = d.withColumn("block", F.pmod(F.xxhash64(*key, F.lit(-1 - level)), "blocks")).drop("blocks")
    d = d.withColumn("draw", drawn(level, "doc_id", "source", "size"))

    def pairs(block: pa.Table) -> pa.Table:
        block = block.sort_by([("size", "descending"), ("draw", "ascending"), ("doc_id", "ascending")])
        size, share, draw = (block.column(c).to_numpy() for c in ("size", "share", "draw"))
        share, held = pivoted(size.astype(np.float64), share, draw)
        more = np.zeros(len(size), bool)
        if held >= 0:
            more[held] = True
        out = block.drop_columns(["block", "draw"])
        out = out.set_column(out.schema.get_field_index("share"), "share", pa.array(share))
        return out.set_column(out.schema.get_field_index("more"), "more", pa.array(more))

    return d.groupBy("source", "block").applyInArrow(pairs, units.schema)


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row of ``docs`` (doc_id, text, source).

    taken is a whole number of times size, at most MOST_COPIES. NULL is a source of its own, the last in order; a
    NULL or empty text has no words and gives none, and a source without words has the target 0. Rows of one id,
    source and size are alike: of n such rows with a share p, the whole part of n * p are taken once more, and one
    row more is rounded with the rest. A rerun gives the same rows. Further columns play no part; an empty
    table gives no rows.
    """
    sized = materialized(sizes_of(docs))
    sources = materialized(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    goals = materialized(targets(sources).withColumnRenamed("source", "__source"))
    units = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    units = units.join(goals, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.withColumn("base", F.floor(copies + EPSILON)).withColumn("share", F.greatest(copies - F.col("base"), F.lit(0.0)))
    once = F.floor(F.col("rows") * F.col("share") + EPSILON)
    units = units.withColumn("once", once).withColumn("share", F.greatest(F.col("rows") * F.col("share") - F.col("once"), F.lit(0.0)))
    fractional = (F.col("size") > 0) & (F.col("share") > EPSILON)
    units = materialized(units.withColumn("more", fractional))
    done, open_, level = units.filter("NOT more"), units.filter("more"), 0
    while (open_.groupBy("source").count().agg(F.max("count")).first()[0] or 0) > 1:
        after = materialized(rounded(open_, level))
        done = done.unionByName(after.filter("NOT more"))
        open_, level = after.filter("more"), level + 1
    done = done.unionByName(open_)
    # rows that are alike in all, some taken once more than the others, in runs of bounded length
    extra = F.col("once") + F.when(F.col("size") > 0, F.round("share")).otherwise(0).cast("long")
    done = done.withColumn("extra", extra).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(rows - 1) div {ALIKE}"))))
    first = F.col("run") * ALIKE
    done = done.withColumn("nth", F.explode(F.sequence(first, F.least(first + ALIKE, F.col("rows")) - 1)))
    taken = F.col("size") * (F.col("base") + (F.col("nth") < F.col("extra")).cast("long"))
    return done.select("doc_id", "size", "source_size", "target", taken.alias("taken"))
