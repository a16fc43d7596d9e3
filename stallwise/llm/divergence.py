"""How the sources of a language differ in their words, by Gustavson row accumulation.

Terms that enough documents of a language use form its term-major index: each term with its posting list,
the sources that use it and how often. The index is dealt in blocks of terms. In a block every source
takes its terms one after the other and scatters them through the posting lists into a dense accumulator,
one cell for each peer, so no pair of postings is ever a row. Most sources lack most terms, and a term that
a source lacks has a baseline share above zero there. The accumulator starts with what all terms would
give at the baselines, and each posting corrects that by what it changes: once where only one of the two
sources has the term, again where both have. What leaves a block is a row per pair of sources and at most
``TOP`` terms of each source.

All numbers are whole; shares are in parts of a thousand million.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwise.sources.scratch import materialized

#: Documents of its language that must use a term, terms listed of a source, parts of a whole share, and what is added to each count.
LEAST_DOCUMENTS, TOP, WHOLE, ADDED = 10, 10, 10**9, 2
#: Distinct terms that a task counts before it hands them on.
HELD = 200_000
#: Postings of a block: more where a language has many sources, as a block gives a row per pair of them.
LEAST_BLOCK, MOST_BLOCK = 1 << 14, 1 << 22
#: Sources whose rows one task accumulates, and postings gathered at a time.
ROWS, GATHERED = 2048, 1 << 20
#: A-Z become a-z; a-z and what is not ASCII stay; all else parts terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_PART = "lang string, source string, part string, item string, value bigint"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_TABLE).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term; tasks add up their rows first."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (uses, docs_) in held.items():
                terms = [t.decode() for t in uses]
                rows = [pa.array([v] * len(terms), pa.string()) for v in (lang, source)]
                rows += [pa.array(terms, pa.string()), pa.array(list(uses.values()), pa.int64())]
                rows.append(pa.array([docs_[t] for t in uses], pa.int64()))
                yield pa.RecordBatch.from_arrays(rows, names=["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start in range(0, batch.num_rows, 64):
                for k, text in enumerate(batch.column(2).slice(start, 64).to_pylist(), start):
                    uses, docs_ = held.setdefault((langs[k], sources[k]), (Counter(), Counter()))
                    terms = terms_of(text)
                    uses.update(terms)
                    docs_.update(set(terms))
                if sum(len(uses) for uses, _ in held.values()) > HELD:
                    yield from handed()
        yield from handed()

    d = docs.select("lang", "source", "text").mapInArrow(partial, "lang string, source string, term string, n bigint, docs bigint")
    return d.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(WHOLE * (counts + ADDED) / whole) by long division in steps of a thousand, exact while whole is under 9e15."""
    out, rest = np.divmod(counts + ADDED, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def accumulated(ptr: np.ndarray, peer: np.ndarray, n: np.ndarray, totals: np.ndarray, kept: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its accumulator over all peers) for each of ``rows``, over the terms of one block.

    Posting k says that source ``peer[k]`` has the term n[k] times; the postings of term t are
    ptr[t]:ptr[t + 1]. ``totals`` are the occurrences of all kept terms in each source, ``kept`` is the
    number of those terms.
    """
    whole = totals + ADDED * kept
    zero = share(np.zeros_like(whole), whole)
    p = share(n, whole[peer]) if len(n) else n
    lengths = np.diff(ptr)
    term = np.repeat(np.arange(len(lengths)), lengths)
    by_row = np.argsort(peer, kind="stable")
    ends = np.searchsorted(peer[by_row], np.arange(len(totals) + 1))
    # equal counts of a source weigh the same against any baseline, so they are taken together
    (kind_peer, kind_p), alike = np.unique(np.stack([peer, p]), axis=1, return_counts=True)
    for g in rows.tolist():
        flat = gap(zero[g], zero)
        acc = len(lengths) * flat
        mine = kind_peer == g
        for q, times in zip(kind_p[mine].tolist(), alike[mine].tolist(), strict=True):
            acc += times * (gap(np.int64(q), zero) - flat)
        theirs = alike * (gap(zero[g], kind_p) - flat[kind_peer])
        np.add.at(acc, kind_peer, theirs)
        own = by_row[ends[g] : ends[g + 1]]
        reach = np.cumsum(lengths[term[own]])
        at = 0
        while at < len(own):
            stop = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + GATHERED, side="right")))
            some = own[at:stop]
            each = lengths[term[some]]
            start = np.cumsum(each) - each
            posting = np.repeat(ptr[term[some]] - start, each) + np.arange(int(each.sum()))
            h, ph, pg = peer[posting], p[posting], np.repeat(p[some], each)
            change = gap(pg, ph) - gap(pg, zero[h]) - gap(zero[g], ph) + flat[h]
            # a sum of gaps is under the sum of both shares, 4e9 and the number of terms, so doubles hold it exactly
            acc += np.rint(np.bincount(h, weights=change, minlength=len(acc))).astype(np.int64)
            at = stop
        yield g, acc


def top_terms(ptr: np.ndarray, peer: np.ndarray, n: np.ndarray, totals: np.ndarray, kept: int, rows: np.ndarray, terms: pa.Array) -> Iterator[tuple[int, list[str], list[int]]]:
    """(row, terms, values) of the terms that a source uses more than its language, at most TOP, in order."""
    if not len(n):
        return
    p = share(n, totals[peer] + ADDED * kept)
    term = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    q = share(np.add.reduceat(n, ptr[:-1]), totals.sum() + ADDED * kept)[term]
    value = gap(p, q)
    more = np.flatnonzero((p > q) & np.isin(peer, rows))
    more = more[np.argsort(peer[more], kind="stable")]
    for part in np.split(more, np.flatnonzero(np.diff(peer[more])) + 1):
        if len(part) > TOP:
            part = part[value[part] >= np.partition(value[part], -TOP)[-TOP]]
        named = terms.take(pa.array(term[part])).to_pylist()
        best = sorted(zip((-value[part]).tolist(), named, strict=True), key=lambda x: (x[0], x[1].encode()))[:TOP]
        if best:
            yield int(peer[part[0]]), [t for _, t in best], [-v for v, _ in best]


def block_rows(index: pa.Table, peers: pa.Table) -> pa.Table:
    """What one block gives for one share of the sources: the columns of ``_PART``."""
    peers = peers.combine_chunks().sort_by("source")
    sources, totals = peers.column("source").combine_chunks(), peers.column("total").to_numpy()
    lang, kept, shares, mine = (peers.column(c)[0].as_py() for c in ("lang", "kept", "shares", "share"))
    rows = np.arange(mine, len(totals), shares)
    index = index.combine_chunks()
    who, n = (pa.concat_arrays(index.column(c).chunks) if index.num_rows else pa.array([], pa.list_(t)) for c, t in (("who", pa.string()), ("n", pa.int64())))
    ptr = np.concatenate([[0], np.cumsum(pc.list_value_length(who).to_numpy(zero_copy_only=False))]).astype(np.int64)
    peer = pc.index_in(who.flatten(), value_set=sources).to_numpy(zero_copy_only=False).astype(np.int64)
    n = n.flatten().to_numpy(zero_copy_only=False)
    out: list[tuple[str, pa.Array, pa.Array, np.ndarray]] = []
    for g, acc in accumulated(ptr, peer, n, totals, kept, rows):
        others = np.delete(np.arange(len(acc)), g)
        out.append((sources[g].as_py(), "pair", sources.take(pa.array(others)), acc[others]))
    if index.num_rows:
        terms = pa.concat_arrays(index.column("term").chunks)
        for g, named, values in top_terms(ptr, peer, n, totals, kept, rows, terms):
            out.append((sources[g].as_py(), "term", pa.array(named, pa.string()), np.array(values, np.int64)))
    size = [len(x[3]) for x in out]
    columns = [
        pa.array([lang] * sum(size), pa.string()),
        pa.array([x[0] for x, k in zip(out, size, strict=True) for _ in range(k)], pa.string()),
        pa.array([x[1] for x, k in zip(out, size, strict=True) for _ in range(k)], pa.string()),
        pa.concat_arrays([x[2] for x in out]) if out else pa.array([], pa.string()),
        pa.array(np.concatenate([x[3] for x in out]) if out else [], pa.int64()),
    ]
    return pa.Table.from_arrays(columns, names=["lang", "source", "part", "item", "value"])


def divergences(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank of every source of every language of ``docs`` (text, lang, source).

    Part ``pair`` lists all other sources of the language by the sum of gaps over its kept terms, part
    ``term`` the TOP terms that the source uses more than the language. NULL text, lang and source are as
    empty ones, empty texts have no terms; a source without terms is listed at its baselines, a language
    without kept terms gives 0 for all pairs, and a language of one source no pairs. A repeated row is a
    document of its own. Equal values are ranked by the UTF-8 order of the item. An empty table gives no
    rows; columns of other names play no part.
    """
    d = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = materialized(term_counts(d))
    posting = F.collect_list(F.struct("source", "n")).alias("postings")  # one for each source at most
    index = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), posting).filter(F.col("docs") >= LEAST_DOCUMENTS)
    index = materialized(index.select("lang", "term", F.col("postings.source").alias("who"), F.col("postings.n").alias("n")))
    used = index.select("lang", F.explode(F.arrays_zip("who", "n")).alias("e")).groupBy("lang", F.col("e.who").alias("source"))
    groups = d.select("lang", "source").distinct().join(used.agg(F.sum("e.n").alias("total")), ["lang", "source"], "left")
    groups = materialized(groups.select("lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total")))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("peers"))
    kept = index.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum(F.size("who")).alias("entries"))
    sizes = sizes.join(kept, "lang", "left").fillna(0, ["kept", "entries"])
    each = F.least(F.lit(MOST_BLOCK), F.greatest(F.lit(LEAST_BLOCK), F.col("peers") * F.col("peers")))
    blocks, shares = F.greatest(F.lit(1), F.ceil(F.col("entries") / each)), F.ceil(F.col("peers") / ROWS)
    # written, so that its size is known: the rows of a language of a third of all may be split
    plan = materialized(sizes.select("lang", "kept", blocks.alias("blocks"), shares.alias("shares")))
    over = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    peers = groups.join(plan, "lang").withColumn("block", over("blocks")).withColumn("share", over("shares"))
    dealt = index.join(plan, "lang").withColumn("block", F.pmod(F.xxhash64("term"), "blocks")).withColumn("share", over("shares"))
    key = ["lang", "block", "share"]
    found = dealt.select(*key, "term", "who", "n").groupBy(*key).cogroup(peers.select(*key, "source", "total", "kept", "shares").groupBy(*key))
    rows = materialized(found.applyInArrow(block_rows, _PART))
    pairs = rows.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = rows.filter("part = 'term'").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= TOP)
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(terms)


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM g) LEFT JOIN kept USING (lang) GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
filled AS (
  SELECT g.lang, g.source, kept.term, coalesce(n, 0) AS n
  FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (
  SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
  FROM filled JOIN v USING (lang)),
q AS (
  SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) JOIN v USING (lang)),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gaps ON gaps.lang = a.lang AND gaps.source = a.source AND gaps.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 10
"""
