"""Near-duplicate classes by Order MinHash and banded alignment.

A text's k-mers are its shingles of five lower-cased words, each labelled with its occurrence. A
sketch samples the labelled k-mers of the three least hashes under one hash function and keeps them in
text order, so texts share a sketch if they share content in the same order. Texts with a sketch in
common form a bucket. In a bucket the members are compared with a few hubs only: a bucket of thousands
of copies gives a number of pairs in proportion to its members. First hubs are the members that share the
most, as the text that the others are copies of does. Linked texts are contracted to one label at once,
so later rounds, with other hubs, compare only what is still apart. What shares a bucket and is apart after
the hub rounds is compared exactly: texts of that similarity share one of their rarest shingles, by which
they are joined.

Two texts are linked if the Jaccard similarity of their shingle sets is 0.8 or more and a banded
alignment of their words finds a common subsequence of as large a part of both.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import free_name, with_python
from stallwise.llm.decontaminate import shingle_hashes
from stallwise.sources.scratch import materialized

SHINGLE, SIMILARITY = 5, 0.8
#: Two texts at the threshold share one sketch with probability of about 0.5, and one of 20 all but surely.
SKETCHES, SAMPLED = 20, 3
#: (sketches, hubs of a bucket, whether the hubs are those with the most company) of each round.
ROUNDS = ((4, 1, True), (SKETCHES, 4, True), (SKETCHES, 4, False))
#: Bits of the filter that keeps texts without company out of the shuffle: 2 MB at any size.
FILTER_BITS = 1 << 24
#: Cells in which shingles are counted to order them by rarity; texts that share a cell only blur the order.
CELLS = 1 << 20
CACHED = 200_000
_SEEDS = np.random.default_rng(11).integers(1, 2**63, (2, SKETCHES, 1), dtype=np.uint64) | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def kmers(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the shingles in text order; a text of fewer words is one shingle."""
    return shingle_hashes(hashes, min(SHINGLE, len(hashes))) if len(hashes) else np.empty(0, np.uint64)


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Each shingle's hash mixed with how often it stood before in the text."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    place = np.arange(len(ranked))
    occurrence = place - np.maximum.accumulate(np.where(first, place, 0))
    out = np.empty_like(shingles)
    out[order] = ranked + occurrence.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return out


def sketches(shingles: np.ndarray) -> np.ndarray:
    """The Order MinHash sketches of a text, one number for each hash function."""
    if not len(shingles):
        return np.empty(0, np.int64)
    marks = labelled(shingles)
    take = min(SAMPLED, len(marks))
    out = np.empty(SKETCHES, np.uint64)
    step = max(1, (1 << 18) // len(marks))
    for at in range(0, SKETCHES, step):
        a, b = _SEEDS[:, at : at + step]
        h = (marks[None] ^ a) * b
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        least = np.argpartition(h, take - 1, axis=1)[:, :take] if take < len(marks) else np.tile(np.arange(take), (len(a), 1))
        least.sort(axis=1)  # back to text order
        total = a[:, 0].copy()
        for k in range(take):
            total = (total ^ marks[least[:, k]]) * np.uint64(0xFF51AFD7ED558CCD)
            total ^= total >> np.uint64(32)
        out[at : at + step] = total
    return out.view(np.int64)


def edits(a: list[int], b: list[int], most: int) -> int | None:
    """Insertions and deletions that turn a into b, searched in a band that widens by one diagonal per edit.

    None if more than ``most`` are needed.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    reach = {1: 0}
    for d in range(most + 1):
        for k in range(-d + 2 * max(0, d - m), d - 2 * max(0, d - n) + 1, 2):
            if k == -d or (k != d and reach.get(k - 1, -1) < reach.get(k + 1, -1)):
                x = reach.get(k + 1, 0)
            else:
                x = reach[k - 1] + 1
            y = x - k
            while x < n and y < m and a[x] == b[y]:
                x += 1
                y += 1
            reach[k] = x
            if x >= n and y >= m:
                return d
    return None


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two texts, as the hashes of their words, are near copies of each other."""
    if len(a) == len(b) and (a == b).all():
        return True
    one, two = np.unique(kmers(a.astype(np.uint64))), np.unique(kmers(b.astype(np.uint64)))
    both = len(np.intersect1d(one, two, assume_unique=True))
    if both < SIMILARITY * (len(one) + len(two) - both):
        return False
    short = min(len(a), len(b))
    apart = np.flatnonzero(a[:short] != b[:short])
    start = int(apart[0]) if len(apart) else short
    apart = np.flatnonzero(a[::-1][: short - start] != b[::-1][: short - start])
    end = int(apart[0]) if len(apart) else short - start
    most = int((1 - SIMILARITY) * (len(a) + len(b)) + 1e-9)
    return edits(a[start : len(a) - end].tolist(), b[start : len(b) - end].tolist(), most) is not None


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, __digest of the text, __key (equal for texts of equal words), __n distinct shingles, __sketches."""

    def make():
        hashes = _Hashes()

        def each(texts):
            for t in texts:
                words = words_of(t)
                if len(hashes) > CACHED:
                    hashes.clear()
                shingles = kmers(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
                yield xxhash.xxh3_128_digest(" ".join(words)), len(np.unique(shingles)), sketches(shingles)

        return each

    d = docs.select("doc_id", F.md5("text").alias("__digest"), F.col("text").alias("__text"))
    return with_python(d, ["__text"], "__key binary, __n int, __sketches array<bigint>", make, drop=["__text"])


def filter_bits(wanted: DataFrame) -> np.ndarray:
    """A packed filter over the digests of ``wanted``; what reaches the driver is FILTER_BITS bits at most."""
    bit = F.pmod(F.xxhash64("digest"), F.lit(FILTER_BITS))
    words = wanted.select(bit.alias("bit")).groupBy(F.expr("bit div 64").cast("int").alias("at"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    found = words.agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("word")).toArrow()
    out[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return out


def word_rows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, words) of the texts whose digests ``wanted`` (digest, key) has; words are 32-bit hashes in text order.

    A filter of fixed size leaves most other texts behind before the join, which is exact.
    """
    packed = docs.sparkSession.sparkContext.broadcast(filter_bits(wanted))

    def make():
        hashes = _Hashes()
        known = packed.value.view(np.uint8)

        def each(bits, texts):
            for bit, t in zip(bits, texts, strict=True):
                if not known[bit >> 3] >> (bit & 7) & 1:
                    yield (None,)
                    continue
                words = words_of(t)
                if len(hashes) > CACHED:
                    hashes.clear()
                all_ = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                yield ((all_ >> np.uint64(32)).astype(np.uint32).tobytes(),)

        return each

    d = docs.select(F.md5("text").alias("digest"), F.col("text").alias("__text")).filter("digest IS NOT NULL")
    d = d.withColumn("__bit", F.pmod(F.xxhash64("digest"), F.lit(FILTER_BITS)))
    found = with_python(d, ["__bit", "__text"], "words binary", make, drop=["__text", "__bit"]).filter("words IS NOT NULL")
    return found.groupBy("digest").agg(F.first("words").alias("words")).join(wanted, "digest").select("key", "words")


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (hub, key and any others) that the alignment confirms."""

    def make():
        def each(ones, twos):
            for a, b in zip(ones, twos, strict=True):
                yield (linked(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)),)

        return each

    d = pairs.join(words.select("key", F.col("words").alias("__b")), "key")
    d = d.join(words.select(F.col("key").alias("hub"), F.col("words").alias("__a")), "hub")
    return with_python(d, ["__a", "__b"], "same boolean", make, drop=["__a", "__b"]).filter("same").select(*pairs.columns)


def contracted(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of ``edges`` (u, v): equal roots in a connected component.

    Each round moves every vertex to the neighbour of the least hash. Two rounds have the same hash: the
    first draws a star's members to the least of them, the second joins them, however many they are; a new
    hash then takes a constant part of the vertices away, chains included. Edges never become more, so
    repeated ones are not looked for.
    """
    roots: DataFrame | None = None
    turn = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn // 2)).alias("h"), F.col(c).alias("to"))  # noqa: B023, E731
        near = both.groupBy("u").agg(F.least(F.min(rank("v")), F.min(rank("u"))).alias("m"))
        moved = materialized(near.select("u", F.col("m.to").alias("to")))
        if roots is None:
            roots = moved.select(F.col("u").alias("v"), F.col("to").alias("root"))
        else:
            step = roots.join(moved.withColumnRenamed("u", "root"), "root", "left")
            roots = materialized(step.select("v", F.coalesce("to", "root").alias("root")))
        new = edges.join(moved, "u").select("v", F.col("to").alias("a"))
        new = new.join(moved.select(F.col("u").alias("v"), F.col("to").alias("b")), "v")
        edges = materialized(new.filter("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")))
        turn += 1
    return roots if roots is not None else edges.select("v", F.col("u").alias("root"))


def paired(key: str, label: str, other: str, other_label: str) -> list[Column]:
    """hub, key, hub_label and label of two texts, the lesser key as the hub."""
    swap = F.col(key) < F.col(other)
    ends = (("hub", key, other), ("key", other, key), ("hub_label", label, other_label), ("label", other_label, label))
    return [F.when(swap, F.col(a)).otherwise(F.col(b)).alias(name) for name, a, b in ends]


def open_members(texts: DataFrame) -> DataFrame:
    """(key, n, company, label, j, bucket) of ``texts`` (key, n, company, s, label)."""
    return texts.select("key", "n", "company", "label", F.explode("s").alias("s")).select("key", "n", "company", "label", "s.*")


def candidate_pairs(texts: DataFrame, sketches_used: int, hubs: int, central: bool, salt: int) -> DataFrame:
    """Distinct (hub, key, hub_label, label) that share a bucket, with different labels and numbers of distinct shingles that allow the similarity."""
    open_ = open_members(texts).filter(F.col("j") < sketches_used)
    order: Column = -F.col("company") if central else F.xxhash64("key", F.lit(salt))
    share = F.pmod(F.xxhash64("key", F.lit(salt + 1)), F.lit(hubs)) if hubs > 1 else F.lit(0).cast("long")
    row = F.struct(order.alias("h"), F.col("key").alias("hub"), F.col("n").alias("hub_n"), F.col("label").alias("hub_label"))
    least = [F.min(F.when(share == k, row)).alias(f"r{k}") for k in range(hubs)]
    found = open_.groupBy("bucket").agg(*least).select("bucket", F.explode(F.array(*[f"r{k}" for k in range(hubs)])).alias("r"))
    found = found.filter("r IS NOT NULL").select("bucket", "r.*")
    bound = F.least("n", "hub_n") >= SIMILARITY * F.greatest("n", "hub_n")
    pairs = open_.join(found.drop("h"), (open_["bucket"] == found["bucket"]) & (F.col("label") != F.col("hub_label")) & bound)
    return pairs.select(*paired("key", "label", "hub", "hub_label")).dropDuplicates(["hub", "key"])


def still_open(texts: DataFrame) -> DataFrame:
    """(key, label) of the texts in a bucket that holds several labels."""
    m = open_members(texts).select("bucket", "key", "label")
    several = m.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("bucket")
    return m.join(several, "bucket").select("key", "label").distinct()


def cell_counts(texts: DataFrame) -> np.ndarray:
    """How many of the ``texts`` (words) have a shingle in each of the CELLS; CELLS numbers reach the driver at any size."""

    def count(batches):
        out = np.zeros(CELLS, np.int64)
        for batch in batches:
            for words in batch.column(0):
                shingles = np.unique(kmers(np.frombuffer(words.as_py(), np.uint32).astype(np.uint64)))
                out += np.bincount((shingles % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        cells = np.flatnonzero(out)
        for at in range(0, len(cells), 1 << 16):
            part = cells[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(out[part])], names=["cell", "n"])

    found = texts.select("words").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CELLS, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def prefix_lengths(n: int) -> tuple[int, int]:
    """How many of its n rarest shingles a text needs to meet all longer, and all shorter, texts of the similarity."""
    return n - int(np.ceil(2 * SIMILARITY / (1 + SIMILARITY) * n - 1e-6)) + 1, n - int(np.ceil(SIMILARITY * n - 1e-6)) + 1


def prefixes(texts: DataFrame) -> DataFrame:
    """(key, label, n, shingle, at) of the rarest distinct shingles of each text (key, label, words), at by rarity.

    Any order that is the same for all texts gives all pairs; that by rarity gives the fewest false ones.
    """
    counts = texts.sparkSession.sparkContext.broadcast(cell_counts(texts))

    def make():
        def each(words):
            for w in words:
                shingles = np.unique(kmers(np.frombuffer(w, np.uint32).astype(np.uint64)))
                order = np.lexsort((shingles, counts.value[(shingles % np.uint64(CELLS)).astype(np.int64)]))
                yield len(shingles), shingles[order[: prefix_lengths(len(shingles))[1]]].view(np.int64).tolist()

        return each

    found = with_python(texts, ["words"], "n int, rare array<bigint>", make, drop=["words"])
    return found.select("key", "label", "n", F.posexplode("rare").alias("at", "shingle"))


def rare_pairs(texts: DataFrame) -> DataFrame:
    """Distinct (hub, key, hub_label, label) of ``texts`` (key, label, words) with different labels: all that can have the similarity.

    Of two texts the shorter is found by its shorter prefix. At the first shingle that both have, what
    follows must suffice for the similarity. A shingle's texts of its most frequent label are not
    paired among themselves, so copies that are linked already add no pairs.
    """
    rows = materialized(prefixes(texts))
    per = rows.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("c"))
    most = per.groupBy("shingle").agg(F.max(F.struct("c", "label")).alias("m"), F.count(F.lit(1)).alias("labels"))
    rows = materialized(rows.join(most.filter("labels > 1").select("shingle", F.col("m.label").alias("main")), "shingle"))
    short = F.col("at") < F.col("n") - F.ceil(F.lit(2 * SIMILARITY / (1 + SIMILARITY)) * F.col("n") - 1e-6) + 1
    names = {c: f"o_{c}" for c in ("key", "label", "n", "at")}
    found = None
    main, other = F.col("label") == F.col("main"), F.col("label") != F.col("main")
    needed = F.lit(SIMILARITY / (1 + SIMILARITY)) * (F.col("n") + F.col("o_n")) - 1e-6
    follow = F.least(F.col("n") - F.col("at"), F.col("o_n") - F.col("o_at"))
    fits = (F.col("n") >= SIMILARITY * F.col("o_n") - 1e-6) & (follow >= needed) & (F.col("label") != F.col("o_label"))
    fits &= (F.col("n") < F.col("o_n")) | ((F.col("n") == F.col("o_n")) & (F.col("key") < F.col("o_key")))
    for one, two in ((other, F.lit(True)), (main, other)):
        longer = rows.filter(two).drop("main").withColumnsRenamed(names).withColumnRenamed("shingle", "o_shingle")
        part = rows.filter(short & one).join(longer, (F.col("shingle") == F.col("o_shingle")) & fits)
        found = part if found is None else found.unionByName(part)
    return found.select(*paired("key", "label", "o_key", "o_label")).dropDuplicates(["hub", "key"])


def merged(texts: DataFrame, pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``texts`` with the label of each after the ``pairs`` (with both labels) that the alignment confirms are linked."""
    found = verified(pairs, words).select(F.col("hub_label").alias("u"), F.col("label").alias("v"))
    roots = contracted(materialized(found))
    moved = texts.join(roots.withColumnRenamed("v", "label"), "label", "left")
    return materialized(moved.withColumn("label", F.coalesce("root", "label")).select(*texts.columns))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), key and label of each row; rows of one class have one label."""
    rows = materialized(sketched(docs))
    nodes = rows.groupBy("__key").agg(F.first("__n").alias("n"), F.first("__sketches").alias("s"), F.min("__digest").alias("digest"))
    nodes = materialized(nodes.withColumnRenamed("__key", "key"))
    single = nodes.select("key", "n", F.posexplode("s").alias("j", "bucket"))
    full = single.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    # the sketches that a text shares, 20 at most, stay in one row with its label
    own = F.collect_list(F.struct("j", "bucket")).alias("s")
    texts = single.join(full, "bucket").groupBy("key", "n").agg(F.sum("c").alias("company"), own)
    texts = materialized(texts.withColumn("label", F.col("key")))
    wanted = materialized(nodes.select("key", "digest").join(texts.select("key"), "key").filter("digest IS NOT NULL").select("digest", "key"))
    words = materialized(word_rows(docs, wanted))
    tried: DataFrame | None = None
    for turn, (used, hubs, central) in enumerate(ROUNDS):
        pairs = candidate_pairs(texts, used, hubs, central, 97 * turn)
        pairs = materialized(pairs if tried is None else pairs.join(tried, ["hub", "key"], "left_anti"))
        tried = pairs.select("hub", "key") if tried is None else tried.unionByName(pairs.select("hub", "key"))
        texts = merged(texts, pairs, words)
    apart = materialized(still_open(texts).join(words, "key"))
    pairs = materialized(rare_pairs(apart).join(tried, ["hub", "key"], "left_anti"))
    labels = merged(texts.select("key", "label"), pairs, words)
    out = rows.select("doc_id", F.col("__digest").alias("digest"), F.col("__key").alias("key"))
    return out.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and class_size of each row of ``docs``.

    class_id is the least doc_id of the class, NULL if none of its rows has one. Texts of equal words
    are copies, whatever white space and letter case; so are all NULL and empty texts. Texts of fewer
    than five words are one shingle. Every repeated row is listed. Columns of other names play no part.
    """
    rows = near_classes(docs)
    # written, so that the join may split the rows of a label that a third of them have
    classes = materialized(rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")))
    return rows.join(classes, "label").select("doc_id", "class_id", "class_size")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, that of the least doc_id (then the least digest), NULLs last."""
    rows = near_classes(docs)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", F.coalesce("digest", F.lit("")).alias("digest")))
    kept = rows.groupBy("label").agg(least.alias("m")).select("m.doc_id", "m.digest")
    ident, digest = free_name(docs, "__ident"), free_name(docs, "__digest")
    kept = kept.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(ident), F.col("digest").alias(digest))
    d = docs.withColumns({ident: F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest: F.coalesce(F.md5("text"), F.lit(""))})
    out = d.join(kept, [ident, digest], "left_semi").dropDuplicates([ident, digest])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
