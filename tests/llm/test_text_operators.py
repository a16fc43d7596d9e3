"""The text operators against brute force, round trips and held-out labels."""

import datetime
import hashlib
import html
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from compare import connect, difference
from stallwise.llm import (
    arrow,
    bpe,
    chat_trees,
    decontaminate,
    html_diff,
    language_fusion,
    order_minhash,
    pii_feistel,
    quality_qda,
    queries,
    rules_gbt,
    secrets_cnn,
    stats,
)

SF = "/root/testdata/sf0.001"
TOKENS = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, ids string"
LONG = " ".join(f"wort{k % 977}" for k in range(30_000))
ODD = [
    (1, None, None, None, None, None, None, None),
    (2, "", "en", "s", 0, 1.0, "x", "y"),
    (3, "", "en", "s", 0, 1.0, "x", "y"),
    (None, "same words here and there again", "en", "s", 31, 1.0, "x", "y"),
    (4, "same words here and there again", "en", "s", 31, 1.0, "x", "y"),
    (4, "same words here and there again", "en", "s", 31, 1.0, "x", "y"),
    (5, LONG, "de", None, len(LONG), 1.0, "x", "y"),
    (6, " \n\t ", "de", None, 4, 1.0, "x", "y"),
]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_matches_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name]) == ""


# --- pseudonyms


def test_permutation_is_one_to_one_and_goes_back():
    for size in (1, 2, 3, 10, 97, 1000):
        images = [pii_feistel.permuted(x, size, b"k", "t") for x in range(size)]
        assert sorted(images) == list(range(size))
        assert [pii_feistel.permuted(x, size, b"k", "t", True) for x in images] == list(range(size))


def test_pseudonyms_keep_format_and_link():
    text = "Pay 4111 1111 1111 1111 or 4111-1111-1111-1111, not 4111111111111112. On 29/02/2024 and 2023-02-29, +1 (017) 555-7713, 10.0.0.7, 999.1.1.1, a.b9@mail.example.org."
    moved, kinds = pii_feistel.pseudonymised(text, b"k")
    assert Counter(kinds) == {"card": 2, "date": 1, "phone": 1, "ip": 1, "email": 1}
    cards = re.findall(r"\d{4}([ -])\d{4}\1\d{4}\1\d{4}", moved)
    assert cards == [" ", "-"] and "4111111111111112" in moved and "2023-02-29" in moved and "999.1.1.1" in moved
    one, two = (re.sub(r"\D", "", m[0]) for m in re.finditer(r"\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}", moved))
    assert one == two != "4" + "1" * 15 and pii_feistel.luhn(one[:-1]) == int(one[-1])
    for value in ("29/02/2024", "555-7713", "10.0.0.7", "a.b9@mail"):
        assert value not in moved
    assert pii_feistel.pseudonymised(moved, b"k", True)[0] == text


def test_pseudonyms_go_back_over_all_documents(docs):
    there = pii_feistel.pseudonyms(docs, b"k")
    back = pii_feistel.pseudonyms(there.select(docs.columns), b"k", back=True).select("doc_id", "text")
    assert back.exceptAll(docs.select("doc_id", "text")).count() == 0
    assert there.agg(F.sum("n_email"), F.sum("n_card")).collect()[0][0] > 0


def test_month_first_dates_stay_apart_and_go_back():
    first, last = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
    dates = [first + datetime.timedelta(k) for k in range((last - first).days + 1)]
    spelled = [f"{d:%m/%d}/{d.year}" for d in dates if d.day > 12]
    images = [pii_feistel.date(x, b"k") for x in spelled]
    assert len(spelled) == 44249 and sorted(images) == sorted(spelled)
    assert [pii_feistel.date(x, b"k", True) for x in images] == spelled
    some = [f"{d:%d/%m}/{d.year}" for d in dates[::7]]
    moved = [pii_feistel.date(x, b"k") for x in some]
    assert not set(moved) & set(images) and [pii_feistel.date(x, b"k", True) for x in moved] == some


def test_equal_values_are_linked_across_spellings():
    phones = ["+49 30 1234567", "+49301234567", "+49 (30) 1234567", "+4930-123-4567", "+49 (0)30 1234567", "+49 (0) 30 123 4567"]
    images = [pii_feistel.phone(x, b"k") for x in phones]
    bare = {re.sub(r"\(0\)|\D", "", x) for x in images}
    assert len(bare) == 1 and bare.pop().startswith("49") and images[4].startswith("+49 (0)")
    assert [pii_feistel.phone(x, b"k", True) for x in images] == phones
    one, two = (pii_feistel.phone(x, b"k") for x in ("(555) 123-4567", "+1 555 123 4567"))
    assert re.sub(r"\D", "", two) == "1" + re.sub(r"\D", "", one)
    assert pii_feistel.phone("+44 20 1234567", b"k")[7:] != pii_feistel.phone("+49 20 1234567", b"k")[7:]
    for day in (25, 7):
        iso, first, dots = (pii_feistel.date(x.format(day), b"k") for x in ("2020-04-{:02}", "{:02}/04/2020", "{}.4.2020"))
        assert first == f"{iso[8:]}/{iso[5:7]}/{iso[:4]}" and dots.split(".") == [str(int(iso[8:])) if day < 10 else iso[8:], str(int(iso[5:7])), iso[:4]]
    iso, us = pii_feistel.date("2020-04-25", b"k"), pii_feistel.date("04/25/2020", b"k")
    assert us == f"{iso[5:7]}/{iso[8:]}/{iso[:4]}" and pii_feistel.date(us, b"k", True) == "04/25/2020"
    days = [datetime.date.fromordinal(k).isoformat() for k in range(pii_feistel.FIRST_DAY, pii_feistel.FIRST_DAY + 3000)]
    moved = [pii_feistel.date(x, b"k") for x in days]
    assert len(set(moved)) == len(days) and [pii_feistel.date(x, b"k", True) for x in moved] == days


def brute_findings(text):
    """Every match of each kind in turn, held against all that were taken before."""
    out = []
    patterns = {"ip": pii_feistel._IP, "date": pii_feistel._DATE, "phone": pii_feistel._PHONE, "card": pii_feistel._CARD}
    for kind in pii_feistel.KINDS:
        spans = pii_feistel._mails(text) if kind == "email" else [m.span() for m in patterns[kind].finditer(text)]
        for start, end in spans:
            clear = not any(a < end and start < b for a, b, _ in out)
            if clear and pii_feistel._MAKE[kind](text[start:end], b"other") is not None:
                out.append((start, end, kind))
    return sorted(out)


def test_findings_equal_brute_force(docs):
    parts = ["a@b.nl", "a@b@c.de.x", "1.2.3.4", "+31 20 1234567", "4111 1111 1111 1111", "2020-04-25", "+49301234567@x.org", "01/02/2003", " ", "x", ",", "-7"]
    draw = random.Random(3)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(2000)]
    texts += [r.text for r in docs.select("text").collect() if r.text]
    for text in texts:
        assert pii_feistel.findings(text) == brute_findings(text)
    assert sum(len(pii_feistel.findings(t)) for t in texts) > 1000


def test_a_text_of_very_many_findings_takes_seconds():
    text = " ".join(f"user{k}@example.org +49 30 {1000000 + k}" for k in range(20_000))
    begun = time.monotonic()
    assert len(pii_feistel.findings(text)) == 40_000
    assert time.monotonic() - begun < 30


def test_pseudonyms_odd_rows(odd, empty):
    rows = pii_feistel.pseudonyms(odd, b"k").collect()
    assert [r["text"] for r in rows] == [r[1] for r in ODD] and rows[0]["label"] is None
    assert pii_feistel.pseudonyms(empty, b"k").count() == 0


# --- order MinHash


def similar(a: list[str], b: list[str]) -> float:
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    one, two = shingles(a), shingles(b)
    return len(one & two) / len(one | two)


def brute_classes(rows):
    words = [order_minhash.words_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for k in range(i):
            close = words[i] == words[k] or (
                min(len(words[i]), len(words[k])) > 4
                and min(len(words[i]), len(words[k])) >= 0.75 * max(len(words[i]), len(words[k]))
                and similar(words[i], words[k]) >= 0.8
            )
            if close:
                root[find(i)] = find(k)
    classes = {}
    for k, (d, _) in enumerate(rows):
        classes.setdefault(find(k), []).append(d)
    return {frozenset(v) for v in classes.values()}


def planted(n: int, seed: int) -> list[tuple[int, str]]:
    """Groups of near copies of different closeness, chains among them, and texts that share a passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for _ in range(n):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 300))]
        for edits in (0, 0, 1, 2, 3, 5, 9):
            copy = list(base)
            for _ in range(edits):
                at = rng.randrange(len(copy))
                rng.choice([lambda: copy.pop(at), lambda: copy.insert(at, "neu"), lambda: copy.__setitem__(at, "neu")])()  # noqa: B023
            rows.append((len(rows), " ".join(copy)))
        rows.append((len(rows), " ".join(passage + [rng.choice(vocabulary) for _ in range(80)])))
    return rows


def test_near_classes_match_brute_force(spark):
    rows = planted(25, 3) + [(10_000, "few words"), (10_001, "few  WORDS"), (10_002, "two words")]
    got = {}
    for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["class_id"], set()).add(r["doc_id"])
        assert r["class_size"] >= 1
    assert {frozenset(v) for v in got.values()} == brute_classes(rows)
    assert all(k == min(v) for k, v in got.items())


def linked_classes(rows):
    """Classes by the comparison of all pairs, without any filter."""
    seen = {}
    words = [np.array([seen.setdefault(w, len(seen) + 1) for w in order_minhash.words_of(t)], np.uint32) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for k in range(i):
            if label[i] != label[k] and order_minhash.linked(words[i], words[k]):
                label = [label[k] if x == label[i] else x for x in label]
    classes = {}
    for k, (d, _) in enumerate(rows):
        classes.setdefault(label[k], set()).add(d)
    return {frozenset(v) for v in classes.values()}


def classes_found(spark, rows):
    got = {}
    for r in order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["class_id"], set()).add(r["doc_id"])
    return {frozenset(v) for v in got.values()}


def test_pairs_of_a_template_farm(spark):
    rows = []
    for pair in range(50):
        for k in range(2):
            words = [f"t{i}" for i in range(400)] + [f"p{pair}_{i}" for i in range(8)] + [f"own{pair}_{k}_{i}" for i in range(42)]
            rows.append((len(rows), " ".join(words)))
    want = linked_classes(rows)
    assert want == {frozenset({2 * pair, 2 * pair + 1}) for pair in range(50)}
    assert classes_found(spark, rows) == want


def test_repeated_lines_do_not_part_copies(spark):
    rows = []
    for k in range(3):
        own, line = ([f"{c}{k}_{i}" for i in range(n)] for c, n in (("w", 50), ("l", 10)))
        rows += [(2 * k, " ".join(own + line * 5)), (2 * k + 1, " ".join(own + line * 9))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    n = {r["doc_id"]: r["__n"] for r in order_minhash.sketched(d).collect()}
    assert all(n[2 * k] == n[2 * k + 1] == 60 for k in range(3))
    assert classes_found(spark, rows) == linked_classes(rows) == {frozenset({2 * k, 2 * k + 1}) for k in range(3)}


def test_order_matters():
    words = np.arange(1, 400, dtype=np.uint64) * np.uint64(7919)
    swapped = np.concatenate([words[200:], words[:200]])
    assert order_minhash.linked(words.astype(np.uint32), words.astype(np.uint32))
    assert not order_minhash.linked(words.astype(np.uint32), swapped.astype(np.uint32))
    shingles = order_minhash.kmers(words)
    assert (order_minhash.sketches(shingles) == order_minhash.sketches(shingles)).all()


def test_edits_against_table():
    rng = random.Random(5)
    for _ in range(60):
        a = [rng.randrange(4) for _ in range(rng.randrange(0, 14))]
        b = [rng.randrange(4) for _ in range(rng.randrange(0, 14))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for k in range(len(b)):
                table[i + 1][k + 1] = table[i][k] + 1 if a[i] == b[k] else max(table[i][k + 1], table[i + 1][k])
        want = len(a) + len(b) - 2 * table[-1][-1]
        assert order_minhash.edits(a, b, 40) == want
        assert order_minhash.edits(a, b, want - 1) is None


def test_contracted_chains(spark):
    edges = [(bytes([k]), bytes([k + 1])) for k in range(60)] + [(b"x", b"y"), (b"y", b"z"), (b"x", b"z")]
    roots = {bytes(r["v"]): bytes(r["root"]) for r in order_minhash.contracted(spark.createDataFrame(edges, "u binary, v binary")).collect()}
    assert len({roots[bytes([k])] for k in range(61)}) == 1 and len({roots[k] for k in (b"x", b"y", b"z")}) == 1
    assert roots[b"x"] != roots[bytes([0])]


def test_stars_are_contracted_in_two_rounds(spark, monkeypatch):
    written = []
    keep = order_minhash.materialized
    monkeypatch.setattr(order_minhash, "materialized", lambda d: written.append(d) or keep(d))
    edges = [(b"hub", k.to_bytes(2, "big")) for k in range(400)] + [(b"other", b"end")]
    roots = order_minhash.contracted(spark.createDataFrame(edges, "u binary, v binary")).collect()
    assert len(roots) == 403 and len({bytes(r["root"]) for r in roots}) == 2
    assert len(written) <= 5  # two rounds; every new hash alone leaves half of the members


def test_dedup_odd_rows(odd, empty):
    rows = order_minhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    of = {r["doc_id"]: r for r in rows}
    assert of[1]["class_id"] == of[2]["class_id"] == of[6]["class_id"] == 1 and of[1]["class_size"] == 4
    assert of[4]["class_id"] == 4 and of[4]["class_size"] == 3
    kept = order_minhash.one_of_each(odd)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5] and kept.columns == odd.columns
    assert order_minhash.near_duplicates(empty).count() == 0 and order_minhash.one_of_each(empty).count() == 0


# --- quality


def test_counts_against_brute_force(docs):
    def brute(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        hit = {p for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)]

    texts = [r["text"] for r in docs.collect()] + [t[1] or "" for t in ODD] + ["a\x1fb\x85c d e", "x\r\nx\r\n", "a b " * 20]
    for text in texts:
        assert stats.describe(text)[0] == brute(text)


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in queries.op3_quality_classifier(spark, sf).collect()}
    verdicts = {r["doc_id"]: r for r in queries.op9_quality_rules(spark, sf).collect()}
    known = spark.read.parquet(f"{sf}/labels.parquet").collect()
    aside = [r for r in known if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all(rows[r["doc_id"]]["held_out"] == (r in aside) for r in known)
    assert np.mean([rows[r["doc_id"]]["predicted"] == r["quality"] for r in aside]) > 0.97
    judged = [r for r in aside if not verdicts[r["doc_id"]]["base_failed"]]
    assert np.mean([verdicts[r["doc_id"]]["kept"] == bool(r["quality"]) for r in judged]) > 0.95
    assert all(0 < r["score"] < 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())


def test_quality_density():
    rng = np.random.default_rng(2)
    rows = np.abs(rng.normal(0.1, 0.05, (40, len(stats.FEATURES))))
    x = quality_qda.transformed(rows)
    own = np.cov(x.T, bias=True) + np.eye(x.shape[1]) * 0.1
    model = quality_qda.Quadratic(np.stack([x.mean(0), x.mean(0) + 0.1]), np.linalg.cholesky(np.stack([own, 2 * own])), np.array([np.linalg.slogdet(own)[1], np.linalg.slogdet(2 * own)[1]]), 0.3)

    def density(mean, cov):
        d = x - mean
        return -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1]

    want = density(x.mean(0) + 0.1, 2 * own) - density(x.mean(0), own) + 0.3
    assert np.allclose(model.difference(rows), want)


def test_quality_odd_rows(spark, odd, empty, labels):
    none = spark.createDataFrame([], LABELS)
    rows = quality_qda.quality_scores(odd, none).collect()
    assert len(rows) == len(ODD) and {r["score"] for r in rows} == {0.5}
    assert quality_qda.quality_scores(empty, labels).count() == 0
    kept = quality_qda.kept_by_quality(odd, none)
    assert kept.count() == len(ODD) and kept.columns == odd.columns
    verdicts = {r["doc_id"]: r for r in rules_gbt.quality_rules(odd, none).collect()}
    assert verdicts[1]["n_words"] == 0 and verdicts[1]["base_failed"] and not verdicts[1]["kept"]
    assert rules_gbt.quality_rules(empty, none).count() == 0


def test_training_rows_are_those_of_the_least_hashes(spark):
    known = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("label"), F.array(F.col("id").cast("double")).alias("features"))
    ids = [r["doc_id"] for r in known.orderBy(F.xxhash64("doc_id")).collect()]
    for limit in (500, 4990, 5000, 9000):
        rows = rules_gbt.sampled(known, limit).collect()
        assert [r["features"][0] for r in rows] == ids[:limit]
    assert rules_gbt.sampled(known.limit(0), 10).count() == 0


def test_trees_are_monotonic():
    rng = np.random.default_rng(4)
    x = rng.random((800, len(stats.FEATURES)))
    y = ((x[:, 0] > 0.4) ^ (x[:, 2] > 0.6)).astype(float)  # not falling by itself
    trees = rules_gbt.grown(x, y)
    for name in rules_gbt.FALLING:
        k = stats.FEATURES.index(name)
        steps = []
        for value in np.linspace(0, 1, 21):
            moved = x.copy()
            moved[:, k] = value
            steps.append(trees.odds(moved))
        assert (np.diff(np.stack(steps), axis=0) <= 1e-9).all()
    assert ((trees.odds(x) > 0) == (y == 1)).mean() > 0.7


# --- BPE


def test_bpe_matches_library(docs):
    library, mine = Tokenizer.from_file(TOKENS), bpe.WordBpe(TOKENS)
    texts = [r["text"] for r in docs.collect()]
    texts += ["", " ", "İstanbul ΣΑΣ Σ", "it's 'stand 123 ½ x²", "<|startoftext|> hi <|endoftext|>x", "a\x1cb\x1fc", "é 日本語 😀👍🏽", "a" * 3000, "ﬁ ß ẞ Ǆ"]
    for text in texts:
        ids, decoded = mine.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert decoded == mine.decode(want) == library.decode(want, skip_special_tokens=False)


def test_batches_and_cached_words_are_small(spark):
    spark.conf.unset(arrow.BATCH_ROWS)
    d = spark.range(3000)
    assert arrow.with_python(d, ["id"], "twice long", lambda: lambda ids: ((2 * i,) for i in ids)).agg(F.sum("twice")).first()[0] == 2999 * 3000
    assert spark.conf.get(arrow.BATCH_ROWS) == str(arrow.ROWS_AT_ONCE) == "1000"
    spark.conf.set(arrow.BATCH_ROWS, 700)
    arrow.with_python(d, ["id"], "same long", lambda: lambda ids: ((i,) for i in ids))
    assert spark.conf.get(arrow.BATCH_ROWS) == "700"  # a session's own choice stays
    spark.conf.unset(arrow.BATCH_ROWS)
    model = bpe.WordBpe(TOKENS)
    model.encode("some words, some more")
    assert {type(ids) for ids in [*model.words.new.values(), *model.chunks.new.values()]} == {tuple}


def test_bpe_columns_and_odd_rows(spark, odd, empty):
    rows = bpe.token_digests(odd, TOKENS).collect()
    assert len(rows) == len(ODD)
    nothing = hashlib.sha256(b"").hexdigest()
    assert rows[0]["n_tokens"] == 0 and rows[0]["ids_sha256"] == rows[0]["decoded_sha256"] == nothing
    assert bpe.token_digests(empty, TOKENS).count() == 0
    with pytest.raises(ValueError):
        bpe.encode(odd, TOKENS)  # odd has a column named ids
    d = bpe.decode(bpe.encode(odd, TOKENS, ids="tokens", decoded="first"), TOKENS, ids="tokens", decoded="second")
    assert d.filter("first <> second").count() == 0


# --- decontamination


def test_decontamination_odd_rows(spark, odd, empty):
    item = " ".join(f"q{k}" for k in range(30))
    items = [("a", item), ("a", item), ("b", "Here AND there"), ("c", ""), ("d", None), (None, "wort1 wort2"), ("e", "wort3")]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id string, text string, doc_id int")
    more = odd.union(spark.createDataFrame([(9, "x " + item.replace(" ", "-") + " y", "en", "s", 1, 1.0, "", "")], DOCS))
    rows = {r["doc_id"]: r for r in decontaminate.contamination(more, bench, ["doc_id"]).collect()}
    assert rows[1]["n_words"] == rows[2]["n_hit"] == 0 and not rows[1]["contaminated"]
    assert (rows[4]["n_hit"], rows[4]["n_items"], rows[4]["contaminated"]) == (3, 1, True)
    assert (rows[9]["n_hit"], rows[9]["n_words"], rows[9]["items_sha256"]) == (30, 32, hashlib.sha256(b"a").hexdigest())
    assert rows[5]["n_hit"] == sum(f"wort{k % 977}" in ("wort1", "wort2", "wort3") for k in range(30_000)) and rows[5]["n_items"] == 1
    assert decontaminate.contamination(more, bench, ["doc_id"]).count() == len(ODD) + 1
    assert decontaminate.contamination(empty, bench, ["doc_id"]).count() == 0
    assert decontaminate.contamination(odd, bench.limit(0), ["doc_id"]).filter("contaminated").count() == 0
    kept = decontaminate.clean_documents(more, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5, 6] and kept.columns == more.columns


# --- chat


def test_template_goes_back():
    texts = ["</s>[INST] ok [/INST]", "", "<\\[\\<s>", "a </role> > <role=x> ", " </s>", "\\", "<"]
    for roles in (["user"] * 7, ["assistant"] * 7, ["", "a> b", "user", "system", "assistant", "x>", "[INST]"]):
        text, mask = chat_trees.formatted(roles, texts)
        assert chat_trees.parsed(text) == list(zip(roles, texts, strict=True))
        said = [t for r, t in zip(roles, texts, strict=True) if r == "assistant"]
        assert [chat_trees.unescaped(text[a:b]) for a, b in mask] == said


def test_best_branches(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for tree in range(12):
        parents = {0: None} | {k: rng.randrange(k) for k in range(1, 30)}
        score = {k: rng.randrange(5) for k in parents}
        rows += [(f"t{tree}", k, p, float(score[k]), "user", f"{tree}/{k}") for k, p in parents.items()]
        best = None
        for leaf in set(parents) - set(parents.values()):
            path = [leaf]
            while parents[path[-1]] is not None:
                path.append(parents[path[-1]])
            best = min(best or (1e9,), (-sum(score[k] for k in path), leaf, path[::-1]))
        want[f"t{tree}"] = best[2]
    rows += [("ring", 1, 2, 1.0, "user", ""), ("ring", 2, 1, None, None, None), ("lost", 5, 99, None, None, None)]
    d = spark.createDataFrame(rows, "tree string, node int, parent int, score double, role string, text string")
    got = {}
    for r in chat_trees.chosen_paths(d).orderBy("place").collect():
        got.setdefault(r["tree"], []).append(r["node"])
    assert got == want | {"lost": [5]}
    assert chat_trees.conversations_of(d, branches=2).filter("tree = 't0'").count() == 2


def test_chat_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "hé"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", LONG)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_trees.conversation_digests(d).collect()}
    assert got[None]["n_turns"] == 2 and got[None]["loss_chars"] == 2
    assert got[1]["n_turns"] == 3 and got[1]["loss_sha256"] == hashlib.sha256(LONG.encode()).hexdigest()
    assert chat_trees.conversation_digests(d.limit(0)).count() == 0


# --- pages


def test_article_of_every_page(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.op7_html_text(spark, SF).collect()}
    for page in pages:
        m = re.search(r"<article>(.*?)(?:</article>|\Z)", page["html"], re.S)
        body = re.sub(r"<(/?[a-z][^>]*)(?:>|\Z)", lambda t: " " if re.match(r"/?(p|br|h1)", t[1]) else "", m[1])
        assert got[page["page_id"]]["text"] == " ".join(html.unescape(body).split())
        assert got[page["page_id"]]["n_chars"] == len(got[page["page_id"]]["text"])


def test_pages_without_articles_lose_shared_lines(spark):
    page = "<body><div>Top</div><div>Menu &amp; more</div><p>Own {0}\n text<b>bold</b></p><script>x</script><div>End</div></body>"
    rows = [(k, f"http://h.example/a/{k}", page.format(k), "x") for k in range(3)] + [(7, "http://alone.example/", page.format(7), "x")]
    rows += [(8, None, None, None), (9, "http://[bad", "", None), (9, "http://[bad", "", None)]
    rows += [(10, "http://h.example/b", "<header>no</header><article><header><h1>T</h1></header>x<nav>n</nav><div class='comments'>c</div>y &lt;</article> z", "")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in html_diff.main_text(d).collect()}
    assert [got[k] for k in range(3)] == [f"Own {k} textbold" for k in range(3)]
    assert got[7] == "Top Menu & more Own 7 textbold End" and got[8] == got[9] == "" and got[10] == "T x y <"
    assert html_diff.main_text(d).count() == len(rows) and html_diff.main_text(d.limit(0)).count() == 0


def test_alignment_decides_between_articles(spark):
    card = "<article><h2>Read {0}</h2><p>also</article>"
    page = "<main>" + card.format("this") + "<article><h1>T{0}</h1><p>Own {0}<p>A quote</article>" + card.format("that") + "</main><footer>F{0}</footer>"
    rows = [(k, f"http://h.example/a/{k}", page.format(k)) for k in range(4)]
    rows += [(9, "http://copy.example/1", page.format(9)), (10, "http://copy.example/2", page.format(9) + "<footer>more</footer>")]
    got = {r["page_id"]: r["text"] for r in html_diff.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(4)] == [f"T{k} Own {k} A quote" for k in range(4)]  # cards go, a shared line of the article stays
    assert got[9] == got[10] == "Read this also T9 Own 9 A quote Read that also"
    assert html_diff.own_lines([1, 2, 3], [[1, 2, 3], [0, 3]]) == {0, 1} and html_diff.own_lines([1], []) == {0}


def test_loose_marks_do_not_drop_articles():
    def content(page):
        return [t for t, kind in html_diff.lines_of(page) if kind == html_diff.CONTENT]

    assert content('<div class="content with-sidebar"><article>a</article><p>b</div>') == ["a"]
    assert content('<article class="has-sidebar">a<div class="share">b</div></article>') == ["a"]
    assert content('<article style="overflow:hidden" data-class="menu">a<a href="/hidden-valley">b</a></article>') == ["ab"]
    assert content("<article hidden>a</article><nav><article>b</article></nav><main role=main>c<p hidden=''>d</main>") == ["c"]
    assert content('<article><p class="ad">x<p>a<p id=promo>y<div>b</div></article>') == ["a", "b"]
    assert content('<main><ul><li class="ad">x<li>a<ul><li class=ad>y</ul>b</ul><dl><dt class=ad>x<dd>c</dl></main>') == ["a", "b", "c"]
    table = "<main><table><tr class=ad><td>x<tr><td class=ad>y<td>a<table><tr class=ad><td>z</table>b</table></main>"
    assert content(table) == ["a", "b"]


def test_longest_common_lines():
    rng = random.Random(1)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for k in range(len(b)):
                table[i + 1][k + 1] = table[i][k] + 1 if a[i] == b[k] else max(table[i][k + 1], table[i + 1][k])
        assert len(html_diff.shared(a, b)) == table[-1][-1]


# --- language


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op8_language_id(spark, sf).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    aside = [r for r in rows if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert len(rows) == 1250 and np.mean([r["lang"] == lang[r["doc_id"]] for r in aside]) > 0.98
    url = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert np.mean([f"/{r['lang']}/" in url[r["page_id"]] for r in rows if r["page_id"] is not None]) > 0.98


def test_language_odd_rows(spark, odd, empty):
    pages = spark.createDataFrame([(1, "http://a.de/x", "<html lang=de><p>wort1 wort2", "z"), (2, None, None, None)], "page_id long, url string, html string, text string")
    learned = next(k for k in range(100, 200) if zlib.crc32(str(k).encode()) % 3 != 1)
    more = odd.union(spark.createDataFrame([(learned, "wort1 wort2 wort3", "de", "s", 1, 1.0, "", "")], DOCS))
    rows = language_fusion.languages_of(more, pages).collect()
    assert len(rows) == len(ODD) + 3 and all(r["lang"] in ("de", "en") for r in rows)
    assert {r["lang"] for r in rows if r["page_id"] == 1} == {"de"}
    none = language_fusion.languages_of(empty, pages).collect()
    assert [r["lang"] for r in none] == [None, None]


# --- secrets


def test_secrets_against_brute_force(spark, docs):
    def brute(text):
        found = [(m.start(), m.end(), 0) for m in secrets_cnn.ASSIGN.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(), m.end(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
        return ",".join(f"{secrets_cnn.KINDS[k]}:{a}:{b}" for a, b, k in sorted(found, key=lambda s: (s[0], s[2])))

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in queries.op10_secret_scan(spark, SF).collect():
        assert r["base_sha256"] == hashlib.sha256(brute(texts[r["doc_id"]]).encode()).hexdigest()
    for text in ["é API_KEY='abc.def=1' ", "ſecret=abcdefgh", "TOKEN: abcde", "AKIA" + "A" * 16 + " " + "0a" * 12, "toKen=abcdefg", "a" * 23 + " " + "f" * 24]:
        assert ",".join(f"{secrets_cnn.KINDS[k]}:{a}:{b}" for a, b, k in secrets_cnn.base_spans(text)) == brute(text)


def test_network_recall_and_gradient(spark):
    rng = random.Random(6)
    value = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    texts = [f"the token = \"{value('0123456789abcdef', 40)}\" of it" for _ in range(300)]
    texts += [f"call {value('0123456789', 16)} now" for _ in range(300)]
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    net = secrets_cnn.trained(d)
    fresh = [f"see {value('0123456789abcdef', 23)} {value('0123456789', 16)}" for _ in range(50)]
    hex_ = [secrets_cnn.window(t, 4, 27) for t in fresh]
    numbers = [secrets_cnn.window(t, 28, 44) for t in fresh]
    assert (net.probability(np.stack(numbers)) < net.threshold).mean() > 0.9
    known = [secrets_cnn.window(t, *m.span()) for t in texts[:300] for m in re.finditer(r"[0-9a-f]{40}", t)]
    assert (net.probability(np.stack(known)) >= net.threshold).mean() >= 0.95
    assert net.probability(np.stack(hex_)).mean() > net.probability(np.stack(numbers)).mean()


def test_threshold_keeps_recall_of_all_findings(spark):
    rng = random.Random(2)
    value = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    texts = [f"the token = \"{value('0123456789abcdef', 40)}\" of it" for _ in range(300)]
    texts += [f"the token = {value('0123456789', 16)} of it" for _ in range(60)]
    texts += [f"the tokem = {value('0123456789', 16)} of it" for _ in range(400)]  # looks the same to the network
    net = secrets_cnn.trained(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 120)
    known = [secrets_cnn.window(t, *secrets_cnn.candidates(t)[0]) for t in texts[:360]]
    assert (net.probability(np.stack(known)) >= net.threshold).mean() >= 0.97
    counts = np.zeros(2 * secrets_cnn.MOST * secrets_cnn.STEPS + 1, np.int64)
    middle = secrets_cnn.MOST * secrets_cnn.STEPS
    counts[[middle - 900, middle - 700, middle - 650, middle + 5]] = [1, 1, 1, 97]
    net.scale, net.shift = 1.0, 0.0
    assert secrets_cnn.recalling(net, counts) == pytest.approx(1 / (1 + np.exp(650 / secrets_cnn.STEPS)))


def test_network_reads_the_whole_run():
    class Equals:
        """Finds runs that show it an equals sign."""

        threshold = 0.5

        def probability(self, x):
            return (x[:, secrets_cnn.SIDE : secrets_cnn.SIDE + secrets_cnn.VALUE] == secrets_cnn.CLASS[ord("=")]).any(axis=1).astype(float)

    for at in range(130):
        run = "g1" * 33 + "z2" * 32
        texts = [f"see {run[:at]}={run[at + 1 :]} now", f"see {run} now"]
        assert list(secrets_cnn.all_spans(texts, Equals())) == [[(4, 134, 3)], []]
    for length in range(1, 200):
        covered = {k for a, b in secrets_cnn.pieces(7, 7 + length) for k in range(a, b)}
        assert covered == set(range(7, 7 + length))


def test_secret_odd_rows(spark, odd, empty):
    rows = secrets_cnn.secret_digests(odd).collect()
    assert len(rows) == len(ODD) and all(r["spans"] == "" for r in rows)
    assert secrets_cnn.secret_digests(empty).count() == 0
    d = odd.union(spark.createDataFrame([(11, "my password: hunter2hunter2 !", "en", "s", 1, 1.0, "", "")], DOCS))
    clean = secrets_cnn.without_secrets(d)
    got = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == d.columns and got[11]["text"] == "my [SECRET] !" and got[11]["n_chars"] == 13 and got[1]["text"] is None


# --- pipeline


def test_pipeline_against_its_parts(spark, docs, labels):
    kept = docs.collect()
    model = {r["doc_id"]: r["predicted"] for r in quality_qda.quality_scores(docs, labels).collect()}
    step = corpus_pipeline.quality(spark, docs, SF)
    assert sorted(r["doc_id"] for r in step.collect()) == sorted(r["doc_id"] for r in kept if model[r["doc_id"]])
    rows = [(r["doc_id"], r["text"]) for r in step.collect()]
    step = spark.createDataFrame(step.collect(), docs.schema)
    step = corpus_pipeline.near_dedup(spark, step, SF)
    assert {r["doc_id"] for r in step.collect()} == {min(c) for c in brute_classes(rows)}
    step = spark.createDataFrame(step.collect(), docs.schema)
    bad = {r["doc_id"] for r in decontaminate.contamination(step, spark.read.parquet(f"{SF}/benchmark.parquet"), ["doc_id"]).collect() if r["contaminated"]}
    clean = corpus_pipeline.decontamination(spark, step, SF)
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in step.collect()} - bad
    clean = spark.createDataFrame(clean.collect(), docs.schema)
    redacted = corpus_pipeline.secret_scan(spark, clean, SF)
    assert redacted.columns == docs.columns and redacted.count() == clean.count()
    assert not any(secrets_cnn.base_spans(r["text"]) for r in redacted.collect())
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in clean.collect()}
