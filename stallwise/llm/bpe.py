"""Byte-pair encoding with word ends, and decoding.

Each word is a doubly linked list of symbols. A priority queue holds the merge rank of every
neighbouring pair; an entry whose symbols have changed since it was queued is stale and skipped. The
ids of words seen lately are kept in a cache of bounded size.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm.arrow import free_name, hold, with_python

CACHED = 100_000
#: What str.split() takes for white space and the pattern does not.
NOT_SPACE = regex.compile("[\x1c-\x1f]")


class Recent:
    """A function's results for the arguments seen lately: two generations of ``size`` at most."""

    def __init__(self, call, size: int):
        self.call, self.size = call, size
        self.new: dict = {}
        self.old: dict = {}

    def __call__(self, key):
        found = self.new.get(key) or self.old.get(key) or self.call(key)
        if len(self.new) >= self.size:
            self.old = dict(self.new)
            self.new.clear()
        self.new[key] = found
        return found

    def clear(self) -> None:
        self.new.clear()
        self.old.clear()


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {b: chr(b) for b in plain}
    spare = (chr(256 + k) for k in range(256))
    return [letters[b] if b in letters else next(spare) for b in range(256)]


class WordBpe:
    """A tokenizer file's vocabulary, merges, word pattern and special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = dict(model["vocab"])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (left, right) in enumerate(merges):
            self.ranks[self.vocab[left] << 32 | self.vocab[right]] = rank
            self.made.append(self.vocab[left + right])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.spelled = [self.strings.get(i, "") for i in range(max(self.strings) + 1)]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.final = [self.vocab[c + self.end] for c in letters]
        self.words, self.chunks = Recent(self._word, CACHED), Recent(self._chunk, CACHED)

    def _merged(self, ids: list[int]) -> list[int]:
        n = len(ids)
        if n == 1:
            return ids
        ranks, made = self.ranks, self.made
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        # an entry is rank * n + place: the least rank first, the leftmost among equals
        queue = [ranks[p] * n + k for k in range(n - 1) if (p := ids[k] << 32 | ids[k + 1]) in ranks]
        heapq.heapify(queue)
        while queue:
            rank, k = divmod(heapq.heappop(queue), n)
            m = after[k]
            if ids[k] < 0 or m < 0 or ranks.get(ids[k] << 32 | ids[m]) != rank:
                continue  # stale: one of the two has been merged meanwhile
            new = ids[k] = made[rank]
            ids[m] = -1
            after[k] = end = after[m]
            if end >= 0:
                before[end] = k
                if (found := ranks.get(new << 32 | ids[end])) is not None:
                    heapq.heappush(queue, found * n + k)
            if (start := before[k]) >= 0 and (found := ranks.get(ids[start] << 32 | new)) is not None:
                heapq.heappush(queue, found * n + start)
        return [i for i in ids if i >= 0]

    def _word(self, word: str) -> tuple[int, ...]:
        data = word.encode("utf-8")
        ids = [self.inner[b] for b in data]
        ids[-1] = self.final[data[-1]]
        return tuple(self._merged(ids))

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        found = self.word.findall(chunk)
        return self.words(found[0]) if len(found) == 1 else tuple(i for w in found for i in self.words(w))

    def _plain(self, text: str, parts: list[tuple[int, ...]]) -> None:
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # letter by letter: no final sigma
        # no match of the pattern holds white space, so what stands between it can be looked up whole
        if NOT_SPACE.search(text):
            parts += [self.words(w) for w in self.word.findall(text)]
            return
        new, seek = self.chunks.new, self.chunks
        parts += [new.get(c) or seek(c) for c in text.split()]

    def encode(self, text: str | None) -> tuple[np.ndarray, str]:
        """The ids of a text and the text that they decode to; special tokens in it keep their ids."""
        parts: list[tuple[int, ...]] = []
        at = 0
        for m in self.cut.finditer(text or ""):
            self._plain(text[at : m.start()], parts)
            parts.append((self.special[m[0]],))
            at = m.end()
        self._plain((text or "")[at:], parts)
        ids = list(chain.from_iterable(parts))
        return np.array(ids, np.int32), " ".join(map(self.spelled.__getitem__, ids))

    def decode(self, ids) -> str:
        """The vocabulary strings of the ids, one space between each two, as a file without decoder gives them."""
        return " ".join(self.strings[int(i)] for i in ids if int(i) in self.strings)


@lru_cache(maxsize=2)
def model(path: str) -> WordBpe:
    return WordBpe(path)


def held_model(path: str) -> WordBpe:
    """The model, kept by the worker with its words until a task of another kind comes."""
    hold(model.cache_clear)
    return model(path)


def encode(d: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None, keep_text: bool = True) -> DataFrame:
    """Add the token ids of a text column and, if named, the text they decode to.

    NULL and empty texts have no ids and decode to the empty string. Texts are encoded whole, each
    row by itself; repeated rows stay. A new column may not have the name of one that is there.
    """

    def make():
        bpe = held_model(path)

        def each(texts):
            for t in texts:
                i, s = bpe.encode(t)
                yield (i, s) if decoded else (i,)

        return each

    added = f"`{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")
    return with_python(d, [text], added, make, drop=[] if keep_text else [text])


def decode(d: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the text that a column of ids stands for; NULL ids give the empty string, unknown ids nothing."""

    def make():
        bpe = held_model(path)
        return lambda rows: ((bpe.decode(r or []),) for r in rows)

    return with_python(d, [ids], f"`{decoded}` string", make)


def digests(encoded: DataFrame, doc_id: Column, ids: str, decoded: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of encoded rows."""
    return encoded.select(
        doc_id.alias("doc_id"),
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode the texts of documents, decode them again, and give the digests of both per row."""
    d = docs.select("doc_id", "text")
    ids, decoded = free_name(d, "ids"), free_name(d, "decoded")
    return digests(encode(d, path, ids=ids, decoded=decoded, keep_text=False), F.col("doc_id"), ids, decoded)
