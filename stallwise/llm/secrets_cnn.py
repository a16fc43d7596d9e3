"""Secrets in texts: exact rules for three kinds, and a character convolutional network for the rest.

The rules give the findings that always stand. Every candidate, a long run of token characters with a
digit in it, is also scored by a small convolutional network in numpy that sees the run and the
characters around it. The network learns from the findings themselves: candidates inside a rule's
finding against all others; for half of the training rows what stands around the
value is blanked, so that the value alone must tell. Its scores are calibrated on rows left out of the training. The threshold
keeps the wanted recall of all candidates in findings, and of those that were not trained on; their scores are counted
over all texts. Candidates that pass and touch no finding of the rules are added.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import free_name, with_python

#: The patterns of the rules and the lengths that a finding needs.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "model")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_DIGIT = re.compile(r"[0-9]")
#: Most labelled candidates that the network is trained and calibrated on, per label.
TRAINING_ROWS = 3000
#: What a window shows of a candidate and of each side; longer candidates are read in overlapping windows.
VALUE, SIDE = 40, 14
RECALL, PULL = 0.98, 0.01
#: Logits are counted in steps of this part of 1, up to this size.
STEPS, MOST = 256, 200
FILTERS, WIDTH, CHANNELS, EPOCHS, BATCH, STEP = 24, 5, 8, 6, 64, 0.004
_HEXISH = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))

Span = tuple[int, int, int]  # start, end, place in KINDS


def base_spans(text: str) -> list[Span]:
    """The findings of the rules: per kind leftmost and without overlap, those that are too short dropped."""
    found: list[Span] = []
    lower = text.lower()
    if any(name in lower for name in ASSIGN_NAMES):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if b"h" * 24 in text.encode("utf-8").translate(_HEXISH):
        found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def candidates(text: str) -> list[tuple[int, int]]:
    if not _DIGIT.search(text):
        return []
    return [m.span() for m in CANDIDATE.finditer(text) if _DIGIT.search(m[0])]


def character_classes() -> np.ndarray:
    """Symbol classes of characters 0 to 255: digits, hex letters and quotes apart, other letters by case."""
    out = np.full(256, 9, np.int64)
    for group, chars in enumerate(["0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/_-", "=:", "\"'`", " \t\n"]):
        out[[ord(c) for c in chars]] = group
    return out


CLASS = character_classes()
PAD, SYMBOLS = 10, 11


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(points < 256, CLASS[np.minimum(points, 255)], 9)


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """A candidate in parts of VALUE characters at most, each half over the next, that leave no character out."""
    if end - start <= VALUE:
        return [(start, end)]
    return [(a, a + VALUE) for a in [*range(start, end - VALUE, VALUE // 2), end - VALUE]]


def window(text: str, start: int, end: int) -> np.ndarray:
    """Classes of the characters before, in and after a piece; short parts are padded, and what stands around has symbols of its own."""
    value = text[start:end]
    out = np.full(2 * SIDE + VALUE, PAD)
    before, inside, after = codes(text[max(0, start - SIDE) : start]), codes(value), codes(text[end : end + SIDE])
    out[SIDE - len(before) : SIDE] = before + SYMBOLS
    out[SIDE : SIDE + len(inside)] = inside
    out[SIDE + VALUE : SIDE + VALUE + len(after)] = after + SYMBOLS
    return out


@dataclass
class Network:
    """Embedding, one convolution, maximum over places, two dense layers; then a calibrated sigmoid."""

    embed: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    last: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def _convolved(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = self.embed[x]
        spread = np.concatenate([e[:, k : x.shape[1] - WIDTH + 1 + k] for k in range(WIDTH)], axis=2)
        return spread, spread @ self.kernel + self.bias

    def logits(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        pooled = np.maximum(self._convolved(x)[1].max(axis=1), 0)
        return pooled @ self.out + self.last[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.sure(self.logits(x))

    def sure(self, z):
        """The probability at a logit; low ones stay apart."""
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -700, 40)))


def learned(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Network:
    """Train by Adam on logistic loss over rows of classes and 0/1 labels."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.5, (2 * SYMBOLS, CHANNELS)),
        rng.normal(0, (2 / (WIDTH * CHANNELS)) ** 0.5, (WIDTH * CHANNELS, FILTERS)),
        np.zeros(FILTERS),
        rng.normal(0, FILTERS**-0.5, FILTERS),
        np.zeros(1),
    )
    names = ("embed", "kernel", "bias", "out", "last")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(max(EPOCHS, 400 * BATCH // max(1, len(y)))):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            xb = x[rows].copy()
            blank = rng.random(len(rows)) < 0.5
            xb[blank, :SIDE] = PAD
            xb[blank, SIDE + VALUE :] = PAD
            spread, z = net._convolved(xb)
            best = z.argmax(axis=1)
            top = np.take_along_axis(z, best[:, None], axis=1)[:, 0]
            pooled = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.last[0], -40, 40)))
            d = (p - y[rows]) * weight[rows] / len(rows)
            back = np.outer(d, net.out) * (top > 0)
            grads = {"out": pooled.T @ d, "last": np.array([d.sum()]), "bias": back.sum(axis=0)}
            picked = np.take_along_axis(spread[:, :, None, :], best[:, None, :, None], axis=1)[:, 0]
            grads["kernel"] = np.einsum("bfk,bf->kf", picked, back)
            to_spread = back[:, :, None] * net.kernel.T[None]
            grads["embed"] = np.zeros_like(net.embed)
            for k in range(WIDTH):
                symbols = np.take_along_axis(xb, best + k, axis=1)
                np.add.at(grads["embed"], symbols, to_spread[:, :, k * CHANNELS : (k + 1) * CHANNELS])
            step += 1
            for n in names:
                g = grads[n] + 1e-4 * getattr(net, n) / len(rows)
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - STEP * move)
    return net


def calibrated(net: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """Fit scale and shift of the logits to rows left out, pulled towards 1 and 0, then the threshold.

    The threshold keeps the wanted recall of the findings among these rows; ``recalling`` sets that of all.
    """
    z = net.logits(x)
    a, b = 1.0, 0.0
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))  # never exactly 0 or 1
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        w = p * (1 - p) + 1e-6
        grad = np.array([((p - target) * z).mean() + PULL * (a - 1), (p - target).mean() + PULL * b])
        hess = np.array([[(w * z * z).mean() + PULL, (w * z).mean()], [(w * z).mean(), w.mean() + PULL]])
        a, b = np.array([a, b]) - np.clip(0.5 * np.linalg.solve(hess, grad), -1, 1)  # long steps overshoot where all is sure
    net.scale, net.shift = float(max(a, 1e-3)), float(b)
    sure = np.sort(z[y == 1])
    wanted = sure[int((1 - RECALL) * len(sure))]
    below = z[(y == 0) & (z < wanted)]
    # between the least finding that must be found and the highest other below it
    middle = (wanted + below.max()) / 2 if len(below) else wanted
    net.threshold = float(min(net.sure(middle), net.probability(x[y == 1]).max()))
    return net


def piece_label(a: int, b: int, c: int, d: int, found: list[Span]) -> int | None:
    """1 if the piece c to d of the candidate a to b shows a finding, 0 if it touches none, None if it shows too little of one."""
    label = 0
    for s, e, _ in found:
        shown = min(d, e) - max(c, s)
        if shown > 0:
            if shown >= min(min(b, e) - max(a, s), VALUE // 2):
                return 1
            label = None
    return label


def labelled_candidates(docs: DataFrame) -> DataFrame:
    """(label, window) of every distinct window; label 1: it holds a finding of the rules, or half a window of it.

    Findings that hold no candidate give no window.
    """

    def make():
        def each(texts):
            for t in texts:
                found = base_spans(t or "")
                rows = set()
                for a, b in candidates(t or ""):
                    for c, d in pieces(a, b):
                        label = piece_label(a, b, c, d, found)
                        if label is not None:
                            rows.add((label, bytes(window(t, c, d).astype(np.uint8))))
                yield ([{"label": label, "window": w} for label, w in sorted(rows)],)

        return each

    d = docs.select(F.col("text").alias("__text"))
    found = with_python(d, ["__text"], "__rows array<struct<label: int, window: binary>>", make, drop=["__text"])
    return found.select(F.explode("__rows").alias("r")).select("r.label", "r.window").distinct()


def steps_of_findings(docs: DataFrame, net: Network, known: set[bytes]) -> np.ndarray:
    """How many candidates in findings of the rules have their logit in each step: those with a window of ``known``, and others."""

    def make():
        def each(texts):
            for t in texts:
                t = t or ""
                found = base_spans(t)
                runs = [(t, a, b) for a, b in candidates(t) if any(s < b and a < e for s, e, _ in found)] if found else []
                new = [not any(window(t, c, d).astype(np.uint8).tobytes() in known for c, d in pieces(a, b)) for _, a, b in runs]
                steps = np.floor(np.clip(best_scores(net.logits, runs), -MOST, MOST) * STEPS).astype(int)
                yield ([{"step": int(k), "new": n} for k, n in zip(steps, new, strict=True)],)

        return each

    d = docs.select(F.col("text").alias("__text"))
    found = with_python(d, ["__text"], "__steps array<struct<step: int, new: boolean>>", make, drop=["__text"]).select(F.inline("__steps"))
    out = np.zeros((2, 2 * MOST * STEPS + 1), np.int64)
    for row in found.groupBy("step", "new").count().collect():
        out[int(row["new"]), row["step"] + MOST * STEPS] = row["count"]
    return out


def recalling(net: Network, counts: np.ndarray) -> float:
    """The probability of the highest step with findings that leaves the wanted part of the counted ones at or above it."""
    below = np.cumsum(counts) - counts  # findings under each step
    last = np.flatnonzero((counts > 0) & (below <= (1 - RECALL) * counts.sum() + 1e-9)).max()
    return float(net.sure((int(last) - MOST * STEPS) / STEPS))


def trained(docs: DataFrame, limit: int = TRAINING_ROWS) -> Network | None:
    """A network from at most ``limit`` distinct windows of each label, those of the least hashes.

    None unless both labels occur: then only the rules speak.
    """
    known = labelled_candidates(docs).withColumn("h", F.xxhash64("window"))
    rows = []
    for label in (0, 1):
        rows += known.filter(F.col("label") == label).orderBy("h", "window").limit(limit).collect()
    y = np.array([r["label"] for r in rows], float)
    if len(np.unique(y)) < 2:
        return None
    x = np.stack([np.frombuffer(bytes(r["window"]), np.uint8) for r in rows]).astype(np.int64)
    aside = np.array([r["h"] % 4 == 0 for r in rows])
    if min((y[aside] == k).sum() for k in (0, 1)) < 1 or min((y[~aside] == k).sum() for k in (0, 1)) < 1:
        aside = np.zeros(len(y), bool)
    net = learned(x[~aside], y[~aside])
    net = calibrated(net, x[aside], y[aside]) if aside.any() else calibrated(net, x, y)
    old, new = steps_of_findings(docs, net, {bytes(r["window"]) for r, out in zip(rows, aside, strict=True) if not out})
    net.threshold = min([recalling(net, counts) for counts in (old + new, new) if counts.any()] or [net.threshold])
    return net


def best_scores(score: Callable[[np.ndarray], np.ndarray], runs: list[tuple[str, int, int]]) -> np.ndarray:
    """The highest score of the windows of each candidate (text, start, end)."""
    best = np.full(len(runs), -np.inf)
    parts = [(k, c, d) for k, (_, a, b) in enumerate(runs) for c, d in pieces(a, b)]
    for at in range(0, len(parts), 512):
        part = parts[at : at + 512]
        scores = score(np.stack([window(runs[k][0], c, d) for k, c, d in part]))
        np.maximum.at(best, [k for k, _, _ in part], scores)
    return best


def all_spans(texts: list[str | None], net: Network | None) -> Iterator[list[Span]]:
    """Findings of the rules and, from the network, candidates that touch none of them, by start."""
    found = [base_spans(t or "") for t in texts]
    open_: list[tuple[int, int, int]] = []
    if net:
        for k, t in enumerate(texts):
            open_ += [(k, a, b) for a, b in candidates(t or "") if not any(s < b and a < e for s, e, _ in found[k])]
    if net:
        best = best_scores(net.probability, [(texts[k], a, b) for k, a, b in open_])
        for (k, a, b), p in zip(open_, best, strict=True):
            if p >= net.threshold:
                found[k].append((a, b, 3))
    for spans in found:
        yield sorted(spans, key=lambda s: (s[0], s[2]))


SPANS = "array<struct<start: int, `end`: int, kind: string>>"


def find_secrets(docs: DataFrame, net: Network | None, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``spans`` (start, end, kind) of each row; offsets in code points, end exclusive.

    NULL and empty texts have no spans; repeated rows have the same; further columns play no part.
    """

    def make():
        def each(texts):
            for spans in all_spans(texts, net):
                yield ([{"start": a, "end": b, "kind": KINDS[k]} for a, b, k in spans],)

        return each

    d = docs.select(*keep, F.col(text).alias("__text"))
    return with_python(d, ["__text"], f"spans {SPANS}", make, drop=["__text"])


def secret_digests(docs: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, counts per rule, digest of the rules' spans, and all spans as text, per row of ``docs``."""
    found = find_secrets(docs, trained(docs, limit), ["doc_id"])
    shown = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(shown(F.filter("spans", lambda s: s["kind"] != "model")), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )


def redacted(text: str | None, spans: list[Span], mark: str = "[SECRET]") -> str | None:
    """The text with each run of overlapping spans replaced by ``mark``."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def without_secrets(docs: DataFrame, limit: int = TRAINING_ROWS) -> DataFrame:
    """``docs`` with every span of a text replaced by a mark, and n_chars of the new text if there is such a column.

    No row goes; rows without findings stay as they are.
    """
    net = trained(docs, limit)
    name = free_name(docs, "__clean")

    def make():
        return lambda texts: ((redacted(t, s),) for t, s in zip(texts, all_spans(texts, net), strict=True))

    out = with_python(docs, ["text"], f"`{name}` string", make, drop=["text"])
    changed = {"text": F.col(name)} | ({"n_chars": F.length(name).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return out.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
