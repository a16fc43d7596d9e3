"""Benchmark passages inside documents, by a prefix-filtered join of shingles.

An item's windows are 13 consecutive words. A window can stand in a document only if all its shingles
of five words do, so its rarest shingle is all the prefix that has to be joined (containment 1 needs a
prefix of one). Rarity is the number of places in all documents. Shingles of documents are first held
against a filter of fixed size over the shingles of the benchmark; the join itself, the bounds on
position and length, and the comparison of the window are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import free_name, with_python
from stallwise.sources.scratch import materialized

WINDOW, SHINGLE = 13, 5
#: Bits of the filter: the driver and each task hold 2 MB, whatever the size of the benchmark.
FILTER_BITS = 1 << 24
CACHED = 200_000
#: A-Z become a-z; digits, a-z and what is not ASCII stay; all else parts words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_TABLE).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words, from the hashes of the words."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = (total ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def probes(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two filter bits of each shingle."""
    mask = np.uint64(FILTER_BITS - 1)
    return (shingles & mask).astype(np.int64), ((shingles >> np.uint64(32)) & mask).astype(np.int64)


def windows_of(words: list, window: int = WINDOW) -> Iterator[list]:
    if words:
        for start in range(max(1, len(words) - window + 1)):
            yield words[start : start + window]


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, win, size) of each distinct window of each item; win holds the words with spaces between."""

    def make():
        return lambda texts: (([b" ".join(w).decode() for w in windows_of(words_of(t))],) for t in texts)

    d = benchmark.select("item_id", F.col("text").alias("__text"))
    found = with_python(d, ["__text"], "__wins array<string>", make, drop=["__text"])
    found = found.select("item_id", F.explode("__wins").alias("win")).distinct()
    return found.select("item_id", "win", F.size(F.split("win", " ")).alias("size"))


def window_shingles(windows: DataFrame) -> DataFrame:
    """(win, size, s, offset, shingle): every shingle of every distinct window."""
    s = F.least(F.lit(SHINGLE), F.col("size"))
    d = windows.select("win", "size", s.alias("s"), F.split("win", " ").alias("w")).distinct()
    d = d.select("*", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("s"))).alias("offset"))
    shingle = F.concat_ws(" ", F.slice("w", F.col("offset") + 1, F.col("s")))
    return d.select("win", "size", "s", "offset", shingle.alias("shingle"))


def filter_bits(shingles: DataFrame) -> dict[int, np.ndarray]:
    """Per shingle length, the packed filter over the shingles; at most FILTER_BITS / 64 numbers for each of five lengths."""

    def make():
        def each(texts):
            for t in texts:
                words = np.array([xxhash.xxh3_64_intdigest(w) for w in t.encode().split()], np.uint64)
                a, b = probes(shingle_hashes(words, len(words)))
                yield ([int(a[0]), int(b[0])],)

        return each

    bits = with_python(shingles.select("s", "shingle").distinct(), ["shingle"], "bits array<int>", make, drop=["shingle"])
    bits = bits.select("s", F.explode("bits").alias("bit"))
    word = F.bit_or(F.expr("shiftleft(1L, bit % 64)")).alias("word")
    out: dict[int, np.ndarray] = {}
    for row in bits.groupBy("s", F.floor(F.col("bit") / 64).cast("int").alias("at")).agg(word).collect():
        out.setdefault(row["s"], np.zeros(FILTER_BITS // 64, np.int64))[row["at"]] = row["word"]
    return out


def _segments(hits: list[tuple[int, int]], n: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Merge the reach of windows around (place, length) hits: (start, end, hits in it)."""
    start, end, inside = 0, -1, []
    for place, size in hits:
        a, b = max(0, place + size - WINDOW), min(n, place + WINDOW)
        if inside and a <= end:
            end = max(end, b)
        else:
            if inside:
                yield start, end, inside
            start, end, inside = a, b, []
        inside.append((place, size))
    if inside:
        yield start, end, inside


def shingled(docs: DataFrame, filters: dict[int, np.ndarray]) -> DataFrame:
    """Add __n (words) and __segments (start, words, hits): where shingles of the benchmark may stand."""
    packed = docs.sparkSession.sparkContext.broadcast(filters)

    def make():
        known = {s: f.view(np.uint8) for s, f in packed.value.items()}
        hashes = _Hashes()

        def each(texts):
            for t in texts:
                words = words_of(t)
                if len(hashes) > CACHED:
                    hashes.clear()
                each_hash = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                hits: list[tuple[int, int]] = []
                for s, f in known.items():
                    a, b = probes(shingle_hashes(each_hash, s))
                    hits += [(int(p), s) for p in np.flatnonzero(f[a >> 3] >> (a & 7) & f[b >> 3] >> (b & 7) & 1)]
                found = [
                    {"start": a, "words": [w.decode() for w in words[a:b]], "hits": [{"p": p, "s": s} for p, s in inside]}
                    for a, b, inside in _segments(sorted(hits), len(words))
                ]
                yield len(words), found

        return each

    added = "__n bigint, __segments array<struct<start: int, words: array<string>, hits: array<struct<p: int, s: int>>>>"
    return with_python(docs, ["__text"], added, make, drop=["__text"])


def matches(found: DataFrame, shingles: DataFrame) -> DataFrame:
    """(__row, start, size, win): every place of a window in a row of ``shingled``."""
    seg = found.select("__row", "__n", F.explode("__segments").alias("g")).select("__row", "__n", "g.start", "g.words", F.explode("g.hits").alias("h"))
    first = F.greatest(F.col("start"), F.col("h.p") + F.col("h.s") - WINDOW)
    places = seg.select(
        "__row",
        "__n",
        F.col("h.p").alias("p"),
        F.concat_ws(" ", F.slice("words", F.col("h.p") - F.col("start") + 1, F.col("h.s"))).alias("shingle"),
        first.alias("first"),
        F.slice("words", first - F.col("start") + 1, F.lit(2 * WINDOW)).alias("around"),
    )
    rarity = places.groupBy("shingle").agg(F.count(F.lit(1)).alias("places"))
    ranked = shingles.join(rarity, "shingle", "left")
    rarest = F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "shingle", "offset")).alias("r")
    prefix = ranked.groupBy("win", "size").agg(rarest).filter("r.places > 0").select("win", "size", "r.shingle", "r.offset")
    start = F.col("p") - F.col("offset")
    near = places.join(prefix, "shingle").withColumn("at", start)
    near = near.filter((F.col("at") >= F.col("first")) & (F.col("at") + F.col("size") <= F.col("__n")))
    same = F.concat_ws(" ", F.slice("around", F.col("at") - F.col("first") + 1, F.col("size"))) == F.col("win")
    return near.filter(same).select("__row", F.col("at").alias("start"), "size", "win")


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each of ``docs``: the columns ``keep``, n_words, n_hit, n_items, items_sha256, contaminated.

    NULL and empty texts have no words and no hits; an item without words has no window; an item
    without an id marks words but is not counted or listed. Repeated rows, of documents or items, are
    judged alike and stay; an empty benchmark marks nothing. Further columns play no part.
    """
    windows = materialized(item_windows(benchmark))
    shingles = materialized(window_shingles(windows))
    d = docs.select(*keep, F.col("text").alias("__text"), F.monotonically_increasing_id().alias("__row"))
    found = materialized(shingled(d, filter_bits(shingles)))
    placed = materialized(matches(found.filter(F.size("__segments") > 0), shingles))
    span = F.array_sort(F.collect_set(F.struct("start", F.expr("start + size").alias("stop"))))
    covered = F.aggregate(
        span,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["stop"] - F.greatest(acc["to"], x["start"]))).alias("n"),
            F.greatest(acc["to"], x["stop"]).alias("to"),
        ),
        lambda acc: acc["n"].cast("long"),
    )
    hit = placed.groupBy("__row").agg(covered.alias("n_hit"))
    listed = placed.join(windows.select("item_id", "win"), "win").select("__row", F.col("item_id").cast("string").alias("item"))
    items = listed.groupBy("__row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    out = found.select(*keep, "__row", F.col("__n").alias("n_words")).join(hit, "__row", "left").join(items, "__row", "left")
    out = out.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "items": F.coalesce("items", none)})
    return out.select(
        *keep,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, with all their columns.

    The verdict depends on the text alone, so it is joined by the text's digest.
    """
    name = free_name(docs, "__digest")
    d = docs.select("text", F.md5("text").alias("__digest"))
    bad = contamination(d, benchmark, ["__digest"]).filter("contaminated").select(F.col("__digest").alias(name)).distinct()
    return docs.withColumn(name, F.md5("text")).join(bad, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, s + 1, s + 13), ' ') AS g, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT r, n, s, array_to_string(list_slice(w, s + 1, s + n), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT r, s, pos.n, item_id FROM pos JOIN win USING (g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM m) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
