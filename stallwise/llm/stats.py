"""Statistics of whole texts: exact counts, and the feature rows that the quality models use."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import with_python

#: The characters between words, and the symbols counted.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
SMOOTH_WORDS = 10
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "shout_rate",
    "bar_rate", "digit_rate", "distinct_rate", "top_rate", "echo_rate", "stop_rate", "line_words", "comma_rate",
    "foreign_rate",
)
_IS = {name: np.isin(np.arange(256), list(chars)) for name, chars in {
    "space": SPACES, "symbol": SYMBOLS, "digit": b"0123456789", "upper": bytes(range(65, 91)), "letter": bytes(range(65, 91)) + bytes(range(97, 123)), "inner": bytes(range(0x80, 0xC0)), "wide": bytes(range(0xC0, 0x100)),
}.items()}


def repeated(codes: np.ndarray, size: int = WINDOW) -> int:
    """Words that stand in a window of ``size`` (a power of two) words found at least twice; the first counts too."""
    n = len(codes) - size + 1
    if n < 2:
        return 0
    width = 1
    while width < size:  # two neighbouring windows name one of twice their width
        pairs = codes[:-width] * (int(codes.max()) + 1) + codes[width:]
        width *= 2
        if width < size:
            codes = np.unique(pairs, return_inverse=True)[1]
    _, at, count = np.unique(pairs, return_inverse=True, return_counts=True)
    edges = np.zeros(len(at) + size, np.int64)
    again = np.flatnonzero(count[at] > 1)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + size, -1)
    return int((np.cumsum(edges) > 0).sum())


def describe(text: str | None) -> tuple[list[int], list[float]]:
    """The counts of ``COUNTS`` and the features of ``FEATURES`` of one text; NULL is as the empty text."""
    data = (text or "").encode("utf-8")
    words = data.split()  # at exactly SPACES
    n = len(words)
    if not n:
        return [0] * len(COUNTS), [0.0] * len(FEATURES)
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    total = {name: int(hist[mask].sum()) for name, mask in _IS.items()}
    chars = len(data) - total["inner"] - total["space"]
    codes = {w: k for k, w in enumerate(dict.fromkeys(words))}
    each = np.fromiter(map(codes.__getitem__, words), np.int64, n)
    counts = np.bincount(each)
    lines = [x for x in data.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated(each) if len(codes) < n else 0
    some, many = n + SMOOTH_WORDS, chars + 6 * SMOOTH_WORDS  # a word or two shows no rate
    echoes = int((each[1:] == each[:-1]).sum())
    features = [
        np.log1p(n), chars / n, total["symbol"] / many, dup_lines / len(lines), repeats / some,
        total["upper"] / (total["letter"] + SMOOTH_WORDS), int(hist[33]) / some, int(hist[124]) / some, total["digit"] / many,
        (len(codes) + SMOOTH_WORDS) / some**0.9, int(counts.max()) / some, echoes / some,
        int(hist[46]) / some, np.log1p(n / len(lines)), int(hist[44]) / some, total["wide"] / many,
    ]
    return [n, chars, total["symbol"], dup_lines, repeats], [float(f) for f in features]


def described(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``__counts`` and ``__features`` of the whole text of each row."""

    def make():
        return lambda texts: map(describe, texts)

    d = docs.select(*keep, F.col(text).alias("__text"))
    return with_python(d, ["__text"], "__counts array<bigint>, __features array<double>", make, drop=["__text"])


def held_out(doc_id: Column) -> Column:
    """True for the third of the rows that no model may learn from; NULL ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(d: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, features) of the rows of ``described`` that have a quality label and are not held out.

    A label given twice counts once; a document with both labels counts for both.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__label"))
    known = known.filter(F.col("__label").isin(0, 1) & ~held_out(F.col("__id"))).distinct()
    return d.join(known, F.col("doc_id") == F.col("__id")).select(
        "doc_id", F.col("__label").cast("int").alias("label"), F.col("__features").alias("features")
    )
