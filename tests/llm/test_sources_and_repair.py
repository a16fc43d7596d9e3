"""Source divergence, conversation repair and mixing against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.llm import divergence, mixing, repair

DOCS = "doc_id long, text string, lang string, source string, value long, rank string, target double, part string"
TALK = "conv_id long, turn long, role string, text string, pos string, code string, audit string"


# --- divergence


def brute_divergences(rows):
    """(lang, source, part, item, value, rank) over rows of (text, lang, source), from the definition."""
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), la or "", s or "") for t, la, s in rows]
    out = set()
    for lang in {la for _, la, _ in docs}:
        mine = [(w, s) for w, la, s in docs if la == lang]
        kept = [t for t, n in Counter(t for w, _ in mine for t in set(w)).items() if n >= 10]
        groups = sorted({s for _, s in mine})
        uses = {g: Counter(t for w, s in mine if s == g for t in w) for g in groups}
        uses[None] = Counter(t for w, _ in mine for t in w)
        whole = {g: sum(c[t] for t in kept) + 2 * len(kept) for g, c in uses.items()}
        p = {g: {t: 1 + 10**9 * (c[t] + 2) // whole[g] for t in kept} for g, c in uses.items()}
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for g in groups:
            pairs = [(-sum(gap(p[g][t], p[h][t]) for t in kept), h.encode(), h) for h in groups if h != g]
            terms = [(-gap(p[g][t], p[None][t]), t.encode(), t) for t in kept if uses[g][t] and p[g][t] > p[None][t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out |= {(lang, g, part, item, -value, k + 1) for k, (value, _, item) in enumerate(items)}
    return out


def divergence_rows(frame):
    return {tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in frame.collect()}


def some_documents():
    rng = random.Random(5)
    words = ["straße", "été", "Wort", "wort", "a1b", "x", "ñandú", "the", "of", "Ω", "K", "zz-top"]
    rows = []
    for k in range(160):
        source = rng.choice(["s1", "s2", "é", "Z", None, ""])
        weights = [1 + (hash_ := zlib.crc32(f"{source}{w}".encode())) % 7 for w in words]
        rows.append((" ".join(rng.choices(words, weights, k=rng.randint(0, 30))), rng.choice(["de", "fr", None]), source))
    return [*rows, (None, "de", "quiet"), ("", "it", "one"), ("only here", "it", "two"), ("only here", "xx", "single"), rows[0], rows[0]]


@pytest.mark.parametrize(("least", "rows", "gathered"), [(1 << 14, 2048, 1 << 20), (4, 2, 8)])
def test_divergences_match_the_definition(spark, monkeypatch, least, rows, gathered):
    for name, value in (("LEAST_BLOCK", least), ("MOST_BLOCK", least), ("ROWS", rows), ("GATHERED", gathered)):
        monkeypatch.setattr(divergence, name, value)
    docs = some_documents()
    d = spark.createDataFrame([(k, *r, 1, "x", 0.5, "p") for k, r in enumerate(docs)], DOCS)
    got = divergences = divergence.divergences(d)
    assert divergence_rows(got) == brute_divergences(docs)
    assert divergences.count() == len(brute_divergences(docs))


def test_divergences_of_empty_tables(spark):
    assert divergence.divergences(spark.createDataFrame([], DOCS)).collect() == []


def test_shares_are_exact_beyond_what_doubles_hold():
    counts, whole = np.array([0, 7, 10**14, 3 * 10**14 + 7]), np.array([4 * 10**14 + 13] * 4)
    assert divergence.share(counts, whole).tolist() == [1 + 10**9 * (c + 2) // w for c, w in zip(counts.tolist(), whole.tolist(), strict=True)]


# --- repair


def brute_cheapest(codes):
    """Least (cost, edits) by trying all edits, with three inserted turns in a row at most."""
    n, known = len(codes) // 2, {}

    def best(i, state, inserted):
        if (i, state, inserted) in known:
            return known[i, state, inserted]
        found = [(0, "")] if i == n and state in (0, 3) else []
        moves = []
        after = 3 if state == 2 else 2
        if inserted < 3:
            moves.append(("I", i, after, 2, inserted + 1))
        if i < n:
            role, fault = codes[2 * i : 2 * i + 2]
            moves.append(("D", i + 1, state, 3, 0))
            if fault not in "bd":
                cut = fault == "t"
                moves.append(("R", i + 1, after, 2 + cut, 0))
                if (role, state) in {("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)}:
                    moves.append(("K", i + 1, {"s": 1, "u": 2, "a": 3}[role], int(cut), 0))
        for edit, j, to, cost, ins in moves:
            rest = best(j, to, ins)
            if rest:
                found.append((cost + rest[0], edit + rest[1]))
        known[i, state, inserted] = min(found) if found else None
        return known[i, state, inserted]

    return best(0, 0, 0)


def test_search_finds_the_cheapest_and_least_repair():
    rng = random.Random(3)
    for _ in range(1500):
        codes = "".join(rng.choice("sua?ua") + rng.choice("....bdt") for _ in range(rng.randint(0, 8)))
        want = brute_cheapest(codes)
        assert repair.cheapest(codes) == want, codes
        assert repair.bounds(codes)[0] <= want[0]
        size = 2 * rng.randint(1, 3)
        pieces = [codes[k : k + size] for k in range(0, len(codes), size)] or [""]
        assert repair.joined([repair.piece_answers(p, k == 0, k == len(pieces) - 1) for k, p in enumerate(pieces)]) == want, codes


def brute_repairs(rows):
    """Per conversation (gaps, blank, duplicate, truncated, illegal, cost, audit, digest) after the damage, from the definition."""
    kept, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        kept[conv] += []
        role, text = (" " if x is None else x for x in (role, text))
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        kept[conv] += [(turn is not None, turn or 0, "user" if way == 4 else role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    for conv, said in kept.items():
        said.sort()
        codes, seen, lines = "", set(), []
        for _, _, role, text in said:
            bare = re.sub(r"[\x20\x09-\x0D]+", "", text)
            fault = "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "."
            seen.add((role, text))
            codes += (role[:1] if role[:1] in ("s", "u", "a") else "?") + fault
        cost, audit = brute_cheapest(codes)
        state, at = 0, iter(said)
        for edit in audit:
            _, _, role, text = (0, 0, "", "") if edit == "I" else next(at)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            lines.append(f"{role}:{text}")
        initials = codes[::2]
        turns = {t for known, t, _, _ in said if known}
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(codes[1::2].count(f) for f in "bdt"),
            sum(initials[k : k + 2] not in ("su", "ua", "au") for k in range(len(initials) - 1)),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def talk():
    rng = random.Random(11)
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["Yes.", "No", "", " \n", "Why?", "äö!  ", "a. b? c", None, f"say {turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 2]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "u"]), text))
    return [*rows, *rows[:40]]


@pytest.mark.parametrize("piece", [512, 3])
def test_repairs_match_the_definition(spark, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    rows = talk()
    d = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TALK)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.damaged_repairs(d).collect()}
    want = brute_repairs(rows)
    assert got == want
    assert any(not r[3] and not r[5] for r in got.values())  # a conversation that lost all its rows, or has none to mend


def test_repair_of_a_long_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2] if k % 17 else "tool", f"turn {k}." if k % 5 else "cut") for k in range(5000)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = repair.repairs(d, d).collect()[0]
    codes = "".join(("?" if r == "tool" else r[0]) + ("." if t != "cut" else "d" if k else "t") for k, (_, _, r, t) in enumerate(rows))
    assert got["truncated"] + got["duplicate"] == 1000 and len(got["audit"].replace("I", "")) == 5000
    assert got["cost"] <= 3 * 1000 + 2 * len(codes)


def test_repairs_of_empty_tables(spark):
    assert repair.damaged_repairs(spark.createDataFrame([], TALK)).collect() == []


# --- mixing


def brute_targets(sizes):
    """Targets by the rule, for {source: size}."""
    order = sorted((s for s in sizes if s is not None), key=str.encode) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target = {s: 0.0 for s in order}
    excess, open_ = float(sum(sizes.values())), set(order)
    while excess > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += excess * weight[s] / total
        over = {s for s in open_ if target[s] >= 3 * sizes[s]}
        excess = sum(target[s] - 3 * sizes[s] for s in over)
        for s in over:
            target[s] = 3.0 * sizes[s]
        open_ -= over
    return target


def mix_documents(seed=1, n=900):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        source = rng.choices([None, "", "a", "B", "é", "tiny", "none"], [3, 3, 30, 10, 10, 1, 1])[0]
        words = 0 if source == "none" else min(3000, int(rng.paretovariate(1)))
        rows.append((k, "wort\x0b" * words, "de", source))
    rows += [(9, None, "de", "a"), (None, "same text", "de", "a"), *[(77, "twin text here", "de", "B")] * 500]
    return [(*r, 1, "x", 0.5, "p") for r in rows]


@pytest.mark.parametrize("block", [4096, 16])
def test_mix_meets_its_targets(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing, "ALIKE", 64)
    docs = mix_documents()
    d = spark.createDataFrame(docs, DOCS)
    got = mixing.mixed(d).collect()
    sizes = Counter({r[3]: 0 for r in docs})
    for r in docs:
        sizes[r[3]] += len((r[1] or "").split())
    want = brute_targets(sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len((r[1] or "").split())) for r in docs)
    assert sorted({(r["source_size"], round(r["target"], 6)) for r in got}) == sorted({(sizes[s], round(t, 6)) for s, t in want.items()})
    largest, taken = Counter(), Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["source_size"]] += r["taken"]
        largest[r["source_size"]] = max(largest[r["source_size"]], r["size"])
    for s, t in want.items():
        assert abs(taken[sizes[s]] - t) <= largest[sizes[s]] / 2 + 1
    again = mixing.mixed(d.repartition(5))
    assert Counter(tuple(r) for r in again.collect()) == Counter(tuple(r) for r in got)


def test_pairs_keep_words_and_probabilities():
    rng = np.random.default_rng(4)
    size = np.sort(np.r_[rng.integers(1, 60, 40), 400]).astype(float)[::-1]
    share = np.full(len(size), 0.3)
    total = np.zeros(len(size))
    for _ in range(4000):
        out, held = mixing.pivoted(size, share, rng.random(len(size)))
        assert (size * out).sum() == pytest.approx((size * share).sum())
        assert sum(0 < x < 1 for x in out) == (held >= 0)
        total += out
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def test_mix_of_empty_tables(spark):
    assert mixing.mixed(spark.createDataFrame([], DOCS)).collect() == []
    nothing = spark.createDataFrame([(1, None, "de", None, 1, "x", 0.5, "p"), (2, "", "de", "s", 1, "x", 0.5, "p")], DOCS)
    assert [r["taken"] for r in mixing.mixed(nothing).collect()] == [0, 0]
    assert mixing.mixed(nothing).agg(F.sum("target")).collect()[0][0] == 0
