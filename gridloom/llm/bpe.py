"""Byte-pair encoding and decoding with a pair occurrence index, and token counts with a whole-token shortcut.

The new words of an Arrow batch are merged together.  An index maps each adjacent pair of symbols that has a rank to
all its positions in the batch; a heap holds the active ranks.  Ranks are applied in ascending order, each at all of
its positions at once, and the lists of the pairs beside a merged position are updated.  As no merge can make a pair of
a lower rank than its own (checked when the vocabulary is loaded), this gives what merging each word by itself gives.

Defined results: a null text counts as empty; an empty text or one of only white space has no tokens and decodes to
the empty string; special strings inside a text become their own ids, as is the library's default; repeated rows and
repeated ids are encoded each for itself; other columns of the input aren't read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm import common

VOCABULARY = "word_bpe_49k.json"
#: Words whose encoding a worker keeps; beyond it the store starts anew, so its memory is bounded.
KEPT_WORDS = 400_000
#: A longer word is encoded each time it occurs.
KEPT_LENGTH = 48
#: Unicode white space (fixed values).
SPACE = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
WORD_END = "</w>"
#: Before it, all letters were assigned long ago.
FIRST_RECENT = "\u0530"
#: Letters that Python's Unicode tables lack and the library's have: first and last (fixed values).
NEWER = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CE), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x16EA0, 0x16EB8), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
#: Lower case of capitals among them (fixed values).
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEWER_LOWER |= {0x10D50 + i: 0x10D70 + i for i in range(22)} | {0x16EA0 + i: 0x16EBB + i for i in range(25)}
SHIFT = 20
LOW = (1 << SHIFT) - 1


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where Latin-1 has one, else the next from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    out = [""] * 256
    for b in shown:
        out[b] = chr(b)
    for at, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + at)
    return out


def piece_pattern(unassigned: str) -> Callable[[str], list[str]]:
    """Finds all pre-tokens; unassigned: a character class of what counts as neither a letter nor a number."""
    but = f"--[{unassigned}]" if unassigned else ""
    return regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}{but}]+|[\p{{N}}{but}]|[^{SPACE}[[\p{{L}}\p{{N}}]{but}]]+").findall


#: The same for lower-cased texts within Latin-1, whose letters, numbers and spaces are listed (fixed values).
LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\x09-\x0D\x20\x85\xA0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+").findall


@lru_cache(maxsize=1)
def recent_pieces() -> Callable[[str], list[str]]:
    """The pattern for texts with characters that one library's Unicode tables have as letters and another's don't have yet."""
    newer = regex.compile(r"[\p{L}\p{N}]").match
    spans: list[list[int]] = []
    for at in range(ord(FIRST_RECENT), 0x110000):
        if unicodedata.category(chr(at)) == "Cn" and newer(chr(at)) and not any(a <= at <= b for a, b in NEWER):
            if spans and spans[-1][1] == at - 1:
                spans[-1][1] = at
            else:
                spans.append([at, at])
    return piece_pattern("".join(rf"\U{a:08x}-\U{b:08x}" for a, b in spans))


class Vocabulary:
    """A lower-casing BPE with word ends, as its JSON file describes it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        model = held["model"]
        ids: dict[str, int] = model["vocab"]
        self.specials: dict[str, int] = {x["content"]: x["id"] for x in held["added_tokens"]}
        self.token = {i: t for t, i in ids.items()} | {i: t for t, i in self.specials.items()}
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for a, b in model["merges"]:
            self.rank.setdefault(ids[a] << SHIFT | ids[b], len(self.made))
            self.made.append(ids[a + b])
        self.parts = [(ids[a], ids[b]) for a, b in model["merges"]]
        self.inner_ids = np.array([ids[c] for c in byte_characters()])
        self.last_ids = np.array([ids[c + WORD_END] for c in byte_characters()])
        #: The rank of each pair of single bytes, or -1.
        side = 1 + int(max(self.inner_ids.max(), self.last_ids.max()))
        self.first_rank = np.full((side, side), -1, np.int32)
        for pair, at in self.rank.items():
            if pair >> SHIFT < side and pair & LOW < side:
                self.first_rank[pair >> SHIFT, pair & LOW] = at
        self.string = [str(i) for i in range(1 + max(self.token))]
        self.tokens = [self.token.get(i) for i in range(1 + max(self.token))]
        self.split_specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.pieces = piece_pattern("")
        self.words: dict[str, tuple[int, ...]] = {}
        self.check_ranks()

    def check_ranks(self) -> None:
        """Every merge that uses a symbol must rank after every merge that makes it; then ranks can be applied to all words in turn."""
        made_by: dict[int, int] = {}
        for at, new in enumerate(self.made):
            made_by[new] = at
        for pair, at in self.rank.items():
            if max(made_by.get(pair >> SHIFT, -1), made_by.get(pair & LOW, -1)) >= at:
                raise ValueError("the vocabulary has a merge that ranks before one that makes its parts")

    def merged(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of each word, all merged over one pair occurrence index."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        ends = np.cumsum([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        first = self.inner_ids[data]
        first[ends - 1] = self.last_ids[data[ends - 1]]
        next_ = np.arange(1, len(data) + 1)
        next_[ends - 1] = -1
        previous = np.arange(-1, len(data) - 1)
        previous[np.concatenate(([0], ends[:-1]))] = -1
        ranked = self.first_rank[first[:-1], first[1:]]
        ranked[ends[:-1] - 1] = -1
        at = np.flatnonzero(ranked >= 0)
        at = at[np.argsort(ranked[at], kind="stable")]
        ranks, cuts = np.unique(ranked[at], return_index=True)
        index: dict[int, list[int]] = {r: x.tolist() for r, x in zip(ranks.tolist(), np.split(at, cuts[1:]), strict=True)} if len(at) else {}
        symbol, after, before = first.tolist(), next_.tolist(), previous.tolist()
        active = sorted(index)
        rank_of, parts, made = self.rank.get, self.parts, self.made
        while active:
            rank = heapq.heappop(active)
            (a, b), new = parts[rank], made[rank]
            for i in sorted(index.pop(rank)):
                if symbol[i] != a:
                    continue
                j = after[i]
                if j < 0 or symbol[j] != b:
                    continue
                symbol[i], symbol[j] = new, -1
                right = after[i] = after[j]
                left = before[i]
                if left >= 0 and (found := rank_of(symbol[left] << SHIFT | new)) is not None:
                    if found in index:
                        index[found].append(left)
                    else:
                        index[found] = [left]
                        heapq.heappush(active, found)
                if right >= 0:
                    before[right] = i
                    if (found := rank_of(new << SHIFT | symbol[right])) is not None:
                        if found in index:
                            index[found].append(i)
                        else:
                            index[found] = [i]
                            heapq.heappush(active, found)
        kept = [s for s in symbol if s >= 0]
        counts = np.add.reduceat(np.array(symbol) >= 0, ends - [len(r) for r in raw], dtype=np.int64).tolist() if words else []
        out, at_ = [], 0
        for n in counts:
            out.append(tuple(kept[at_ : at_ + n]))
            at_ += n
        return out

    def pretokens(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if (last := max(text)) >= FIRST_RECENT:
                return recent_pieces()(text.lower().translate(NEWER_LOWER))
            if last > "\xff":
                return self.pieces(text.lower())
        return LATIN_PIECES(text.lower())
    def segments(self, text: str) -> list[tuple[int, list[str]]]:
        """(id of a special string, or -1, the pre-tokens) in the order of the text."""
        if "<|" not in text:
            return [(-1, self.pretokens(text))]
        out = []
        for part in self.split_specials.split(text):
            if part in self.specials:
                out.append((self.specials[part], []))
            elif part:
                out.append((-1, self.pretokens(part)))
        return out

    def learn(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        """Encodings of at least these words."""
        new = sorted(w for w in words if w not in self.words)
        if new:
            found = dict(zip(new, self.merged(new), strict=True))
            if len(self.words) + len(found) > KEPT_WORDS:
                found |= {w: self.words[w] for w in words if w in self.words}
                self.words = {}
            kept = {w: ids for w, ids in found.items() if len(w) <= KEPT_LENGTH}
            if len(kept) <= KEPT_WORDS:
                self.words |= kept
            if len(kept) < len(found) or len(self.words) < len(words):
                return self.words | found
        return self.words

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        parts = [self.segments(t or "") for t in texts]
        every: set[str] = set()
        for p in parts:
            for _, ws in p:
                every.update(ws)
        known = self.learn(every)
        out = []
        for p in parts:
            ids: list[int] = []
            for special, ws in p:
                if special >= 0:
                    ids.append(special)
                for w in ws:
                    ids += known[w]
            out.append(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """The library's decode for a file without a decoder: tokens joined by a space."""
        top = len(self.tokens)
        if ids and (max(ids) >= top or min(ids) < 0):
            ids = [i for i in ids if 0 <= i < top]
        return " ".join(filter(None, map(self.tokens.__getitem__, ids)))


class Counter:
    """Counts tokens: a pre-token of the proven set counts as one, only the rest is merged."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.one = self.proven()
        self.count: dict[str, int] = dict.fromkeys(self.one, 1)

    def proven(self) -> frozenset[str]:
        """The strings of the vocabulary that are a pre-token and that merging by itself turns into one token."""
        v = self.vocabulary
        of = {c: b for b, c in enumerate(byte_characters())}
        strings = []
        for t in v.token.values():
            if t.endswith(WORD_END) and t not in v.specials:
                try:
                    s = bytes(of[c] for c in t.removesuffix(WORD_END)).decode("utf-8")
                except UnicodeDecodeError:
                    continue
                if s and v.pretokens(s) == [s]:
                    strings.append(s)
        return frozenset(s for s, ids in zip(strings, v.merged(strings), strict=True) if len(ids) == 1)

    def count_batch(self, texts: list[str | None]) -> list[int]:
        parts = [self.vocabulary.segments(t or "") for t in texts]
        every: set[str] = set()
        for p in parts:
            for _, ws in p:
                every.update(ws)
        missing = every.difference(self.count)
        known = self.count
        if missing:
            order = sorted(missing)
            found = {w: len(ids) for w, ids in zip(order, self.vocabulary.merged(order), strict=True)}
            if len(self.count) + len(found) > len(self.one) + KEPT_WORDS:
                known = known | found
                self.count = dict.fromkeys(self.one, 1)
            else:
                self.count |= {w: n for w, n in found.items() if len(w) <= KEPT_LENGTH}
                known = self.count if len(self.count.keys() & missing) == len(missing) else self.count | found
        return [sum((special >= 0) + sum(map(known.__getitem__, ws)) for special, ws in p) for p in parts]


@lru_cache(maxsize=2)
def vocabulary(name: str) -> Vocabulary:
    return Vocabulary(public_tokenizers.path(name))


@lru_cache(maxsize=2)
def counter(name: str) -> Counter:
    return Counter(vocabulary(name))


def encode(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, ids array<int>: the token ids of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = vocabulary(name).encode_batch(batch.column("text").to_pylist())
        return pa.record_batch([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return common.by_batch(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, text: of rows (doc_id, ids)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [vocabulary(name).decode(ids or []) for ids in batch.column("ids").to_pylist()]
        return pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return common.by_batch(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes, then decodes the ids, and takes digests of both in one pass."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = vocabulary(name)
        encoded = v.encode_batch(batch.column("text").to_pylist())
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        return pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array([len(ids) for ids in encoded], pa.int64()),
                pa.array([sha(" ".join(map(v.string.__getitem__, ids))) for ids in encoded], pa.string()),
                pa.array([sha(v.decode(ids)) for ids in encoded], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return common.by_batch(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_counts(docs: DataFrame, name: str = VOCABULARY, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        return pa.record_batch([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counter(name).count_batch(texts), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = common.by_batch(docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")), run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
