"""Language of a page or document by fusing evidence.

The text gives likelihoods from hashed byte trigrams, counted per language over all labelled texts. The
declared markup language and the address suffix give likelihoods from how often each is declared among
rows whose text speaks for a language. A host gives a prior, smoothed towards that of its domain, that
towards that of its suffix, and that towards all rows; a row's own vote is taken out of its host's. All
counts are grouped aggregations; what the driver holds are tables of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import with_python
from stallwise.llm.stats import held_out
from stallwise.sources.scratch import materialized

BUCKETS = 1 << 14
#: Most languages that a model may have: the driver and each task hold BUCKETS numbers for each.
MOST_LANGUAGES = 256
#: Neighbouring trigrams repeat each other's evidence, so a text counts as if it had this part of them, and no more than so many.
WEIGHT, MOST_TRIGRAMS = 0.3, 300.0
SMOOTH, STRENGTH = 0.5, 8.0
_MIX = 2654435761
_BLANK = 0x202020 * _MIX % (1 << 32)
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[/!?a-zA-Z](?:[^>\"']++|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+(?:>|\Z)", re.S | re.I)
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,8})", re.I)


def trigrams(text: str | None) -> np.ndarray:
    """The bucket of every run of three bytes of the text's letters, a space at each end and between words."""
    data = (" " + (text or "") + " ").lower().encode("utf-8").translate(_FOLD)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 3 or not data.strip():
        return np.empty(0, np.int64)
    code = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(_MIX)
    return (code >> np.uint32(32 - 14)).astype(np.int64)[code != _BLANK]


def trigram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) over rows of (lang, text); tasks add up their rows first."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for start in range(0, batch.num_rows, 256):
                for lang, text in zip(langs[start : start + 256], batch.column(1).slice(start, 256).to_pylist(), strict=True):
                    if lang not in totals:
                        totals[lang] = np.zeros(BUCKETS, np.int64)
                    totals[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at), pa.string()), "bucket": at, "n": counts[at]})

    found = labelled.select("lang", "text").mapInArrow(partial, "lang string, bucket bigint, n bigint")
    return found.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def text_model(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and the log probability of each bucket in each."""
    counts = materialized(trigram_counts(labelled.filter("lang IS NOT NULL")))
    languages = [r["lang"] for r in counts.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = np.full((len(languages), BUCKETS), SMOOTH)
    for k, lang in enumerate(languages):  # at most BUCKETS rows each
        for r in counts.filter(F.col("lang") == lang).select("bucket", "n").collect():
            table[k, r["bucket"]] += r["n"]
    return languages, np.log(table / table.sum(axis=1, keepdims=True))


def likelihoods(texts: list[str | None], table: np.ndarray) -> Iterator[list[float]]:
    """Per text the tempered log likelihood of each language, the greatest 0."""
    for text in texts:
        at = trigrams(text)
        if not len(at) or not len(table):
            yield [0.0] * len(table)
            continue
        total = table[:, at].sum(axis=1) if len(at) < BUCKETS // 4 else table @ np.bincount(at, minlength=BUCKETS)
        total = total * min(WEIGHT, MOST_TRIGRAMS / len(at))
        yield (total - total.max()).tolist()


def visible(html: str | None) -> tuple[str, str | None]:
    """The text of a page without markup, scripts and styles, and the declared language."""
    html = html or ""
    declared = _DECLARED.search(html)
    return _MARKUP.sub(" ", html), declared[1].lower() if declared else None


def evidence(rows: DataFrame, model: tuple[list[str], np.ndarray], is_html: bool) -> DataFrame:
    """Replace ``text`` by ``ll`` (log likelihoods) and ``declared`` (markup language)."""
    table = rows.sparkSession.sparkContext.broadcast(model[1])

    def make():
        def each(texts):
            read = [visible(t) for t in texts] if is_html else [(t, None) for t in texts]
            return zip(likelihoods([t for t, _ in read], table.value), (d for _, d in read), strict=True)

        return each

    return with_python(rows, ["text"], "ll array<double>, declared string", make, drop=["text"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _votes(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Per value of a column, the sum of the rows' votes for each language."""
    sums = [F.sum(F.col("vote")[k]).alias(f"v{k}") for k in range(n)]
    # written, so that its size is known and a join by a hot value may be split
    return materialized(rows.groupBy(by).agg(*sums).select(by, F.array(*[F.col(f"v{k}") for k in range(n)]).alias(f"{by}_votes")))


def _zip(a, b, f) -> Column:
    return F.zip_with(a, b, f)


def _sum(a) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def fused(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Replace the evidence (ll, declared, host) of rows by lang and probability.

    Without evidence of any kind a row gets the most frequent language; a row without a host or a
    declaration gets nothing from it. lang is NULL and probability 0 without any labelled text.
    """
    n = len(languages)
    if not n:
        return rows.drop("ll", "declared", "host").select("*", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"))
    p = F.transform("ll", lambda x: F.exp(x))
    vote = F.transform("p", lambda x: x / _sum(F.col("p")))
    parts = F.split("host", r"\.")
    suffix = F.when(F.col("host").contains("."), F.element_at(parts, -1))
    domain = F.when(F.size(parts) > 2, F.concat_ws(".", F.slice(parts, -2, 2))).otherwise(F.col("host"))
    d = rows.withColumn("p", p).withColumn("vote", vote).drop("p").withColumns({"suffix": suffix, "domain": domain})
    d = materialized(d)
    total = d.agg(*[F.sum(F.col("vote")[k]).alias(f"v{k}") for k in range(n)]).collect()[0]
    all_votes = np.array([total[k] or 0.0 for k in range(n)])
    base = (all_votes + 1) / (all_votes.sum() + n)
    prior = F.array(*[F.lit(float(x)) for x in base])
    for by in ("declared", "suffix", "domain", "host"):
        d = d.join(_votes(d.filter(F.col(by).isNotNull()), by, n), by, "left")
    none = F.array(*[F.lit(0.0)] * n)

    def others(by: str) -> Column:  # the votes of the other rows
        return F.coalesce(_zip(F.col(f"{by}_votes"), F.col("vote"), lambda v, x: F.greatest(v - x, F.lit(0.0))), none)

    def smoothed(by: str, above) -> Column:
        v = others(by)
        return _zip(v, above, lambda x, y: (x + STRENGTH * y) / (_sum(v) + STRENGTH))

    d = d.withColumn("prior", prior)
    for by in ("suffix", "domain", "host"):
        d = d.withColumn("prior", F.when(F.col("host") != "", smoothed(by, F.col("prior"))).otherwise(F.col("prior")))
    # how much more often a declaration comes with a language than the language itself does
    said = _zip(others("declared"), prior, lambda x, y: (x + y) / (y * (_sum(others("declared")) + 1)))
    d = d.withColumn("said", F.when(F.col("declared").isNotNull(), said).otherwise(F.array(*[F.lit(1.0)] * n)))
    score = _zip(_zip(F.col("ll"), F.col("prior"), lambda x, y: x + F.log(y)), F.col("said"), lambda x, y: x + F.log(y))
    d = d.withColumn("score", score).withColumn("top", F.array_max("score"))
    place = F.array_position("score", F.col("top")).cast("int")
    names = F.array(*[F.lit(x) for x in languages])
    probability = 1.0 / _sum(F.transform("score", lambda x: F.exp(x - F.col("top"))))
    kept = [c for c in rows.columns if c not in ("ll", "declared", "host")]
    return d.select(*kept, F.element_at(names, place).alias("lang"), probability.alias("probability"))


def languages_of(documents: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, page_id, lang and probability of each document and each page.

    The text model learns from ``documents.lang`` of rows that are not held out. A document's source is
    its host; a page has its URL's host and the language of its html element. NULL and empty texts have
    likelihoods alike for all languages; ties go to the language first in the alphabet. Repeated rows
    stay; further columns play no part.
    """
    model = text_model(documents.filter(~held_out(F.col("doc_id"))).select("lang", "text"))
    own = documents.select("doc_id", F.lit(None).cast("bigint").alias("page_id"), F.coalesce("source", F.lit("")).alias("host"), "text")
    web = pages.select(F.lit(None).cast("bigint").alias("doc_id"), "page_id", host_of(F.col("url")).alias("host"), F.col("html").alias("text"))
    rows = evidence(own, model, False).unionByName(evidence(web, model, True))
    return fused(rows, model[0])
