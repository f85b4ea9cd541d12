"""Operators on single texts, against the tokenizers library and plain versions."""

import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridloom.llm import avi, bpe, jpeg, pii, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def samples(n=4000):
    r = random.Random(1)
    alphabet = "aàéΣςİß'stldmrev  \t\n　日本12½!?̧́ẛ.@+-()#\x00\x1c\x85"
    out = ["".join(r.choice(alphabet) if r.random() < 0.97 else "<|endoftext|>" for _ in range(r.randint(0, 60))) for _ in range(n)]
    return [*out, "", " ", "<|startoftext|>", "aaaaaaaaaaaaaaaaaaaa", "x" * 5000, "don't we'll I'M"]


def test_bpe_equals_library(library):
    texts = samples()
    v = bpe.vocabulary(bpe.VOCABULARY)
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert v.encode_batch(texts) == expected
    assert [v.decode(ids) for ids in expected] == [library.decode(ids, skip_special_tokens=False) for ids in expected]
    assert bpe.counter(bpe.VOCABULARY).count_batch(texts) == [len(x) for x in expected]


def test_bpe_stays_right_when_its_store_is_full(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 20)
    v = bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    c = bpe.Counter(v)
    for a in range(0, 600, 50):
        texts = samples(600)[a : a + 50]
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert v.encode_batch(texts) == expected
        assert c.count_batch(texts) == [len(x) for x in expected]


def test_proven_set_is_right(library):
    one = sorted(bpe.counter(bpe.VOCABULARY).one)
    assert all(len(e.ids) == 1 for e in library.encode_batch(one, add_special_tokens=False))


def test_bpe_queries(odd, none, odd_rows, library):
    digests = bpe.round_trip_digests(odd).collect()
    assert len(digests) == len(odd_rows)
    expected = Counter()
    for d, t, *_ in odd_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected[d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(map(tuple, digests)) == expected
    counts = Counter(map(tuple, bpe.token_counts(odd, limit=5).collect()))
    assert counts == Counter((d, len((t or "").encode()), n, n > 5) for (d, t, *_), n in zip(odd_rows, (len(library.encode(x[1] or "", add_special_tokens=False).ids) for x in odd_rows), strict=True))
    assert bpe.round_trip_digests(none).count() == bpe.token_counts(none).count() == 0
    decoded = {(r.doc_id, r.text) for r in bpe.decode(bpe.encode(odd)).collect()}
    assert (5, "one</w> two</w> three</w>") in decoded


def plain_spans(t):
    digits = lambda s: [int(c) for c in s if c in "0123456789"]

    def luhn(ds):
        return sum(x if k % 2 == 0 else 2 * x - 9 * (2 * x > 9) for k, x in enumerate(ds[::-1])) % 10 == 0

    email = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)
    ip = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
    card = re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
    phone = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
    return [[m.span() for m in email], [m.span() for m in ip if all(int(p) <= 255 for p in m[0].split("."))], [m.span() for m in card if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))], [m.span() for m in phone if 9 <= len(digits(m[0])) <= 15]]


def test_plain_identifiers():
    r = random.Random(3)
    texts = ["".join(r.choice("ab.@-+% 0123456789()\n١é") for _ in range(r.randint(0, 80))) for _ in range(20_000)]
    texts += ["4111 1111 1111 1111", "x@y.z@a.b", "1.2.3.4.5.6.7.8", "+1 (555) 010-9999", "a@b.c._x@y.d"]
    assert [pii.detect(t) for t in texts] == [plain_spans(t) for t in texts]


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("mail john.doe [at] example [dot] com now", 0, "john.doe [at] example [dot] com"),
        ("write to jane at example dot com please", 0, "jane at example dot com"),
        ("jоhn@exаmple.com", 0, "jоhn@exаmple.com"),
        ("ａｎｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", 0, "ａｎｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("so ann @ example.com it is", 0, "ann @ example.com"),
        ("write to john at example.com today", 0, "john at example.com"),
        ("write to anna at firma dot cz\ttoday", 0, "anna at firma dot cz"),
        ("or eve dot b at\tshop dot online.", 0, "eve dot b at\tshop dot online"),
        ("a dot b dot c dot d dot e dot f at example dot org", 0, "a dot b dot c dot d dot e dot f at example dot org"),
        ("call plus one four one five five five five two six seven one now", 3, "plus one four one five five five five two six seven one"),
        ("card four one one one one one one one one one one one one one one one end", 2, "four one one one one one one one one one one one one one one one"),
        ("ip one nine two dot one six eight dot one dot seven", 1, "one nine two dot one six eight dot one dot seven"),
        ("+1 (4l5) 555-0134", 3, "+1 (4l5) 555-0134"),
        ("write john at firma.cz or call", 0, "john at firma.cz"),
        ("x" * 80 + " at " + "y" * 80 + ".com", 0, "x" * 80 + " at " + "y" * 80 + ".com"),
    ],
)
def test_disguised_identifiers(text, kind, found):
    plain = pii.detect(text)
    assert [text[a:b] for a, b in pii.added(text, plain)[kind]] == [found]


def test_disguises_in_long_rows():
    row = "a dot " * 50_000 + "b at example.com and" + " a dot" * 50_000
    assert pii.added(row, pii.detect(row))[0] == [(0, 6 * 50_000 + len("b at example.com"))]


@pytest.mark.parametrize("text", ["one" + " " * 100_000 + "dash" + " " * 100_000 + "x", "one" + " " * 100_000, ("one" + " " * 300) * 300, "a" + " " * 100_000 + "at" + " " * 100_000 + "b", "plus " * 50_000])
def test_blanks_are_read_in_linear_time(text):
    began = time.process_time()
    assert not any(pii.added(text, pii.detect(text)))
    assert time.process_time() - began < 1


def plain_look_alikes(text):
    """Spans of the text with look-alikes put in place one by one, mapped back; without those that the plain text shows."""
    kept = [(c, i) for i, own in enumerate(text) for c in pii.LOOK_ALIKES.get(own, own)]
    changed = [pii.LOOK_ALIKES.get(own, own) != own for own in text]
    out = []
    for plain, spans in zip(plain_spans(text), plain_spans("".join(c for c, _ in kept)), strict=True):
        mapped = [(kept[a][1], kept[b - 1][1] + 1, {i for _, i in kept[a:b]}) for a, b in spans]
        out.append([(a, b) for a, b, own in mapped if any(changed[i] for i in own) and not any(a < y and x < b for x, y in plain)])
    return out


def test_look_alikes_equal_a_plain_version():
    r = random.Random(15)
    signs = "аеＡ＠．１２＋‐\u200b"  # no blanks and no o, as those are disguises of another kind, too
    for _ in range(3_000):
        text = "".join(r.choice("ab.@-+0123456789é\n" + signs) for _ in range(r.randint(0, 50)))
        assert pii.added(text, pii.detect(text)) == plain_look_alikes(text)


def test_recall_of_planted_disguises():
    """Identifiers in eight disguises, in texts of ordinary words; nothing is found in the words alone."""
    r = random.Random(14)
    vocab = "we met at noon and looked at the garden door then one of them went on to point out two more plans for a week".split()
    numbers = "zero one two three four five six seven eight nine".split()
    spell = lambda s: " ".join({"+": "plus", ".": "dot"}.get(c) or numbers[int(c)] for c in s)
    name = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    looks = {"a": "а", "e": "е", "c": "с", "i": "і", "h": "һ"}
    caught = clean = 0
    for k in range(800):
        user, host, end = name(6), name(7), r.choice(["com", "org", "cz", "io"])
        phone, ip = "+1" + "".join(r.choice("0123456789") for _ in range(10)), ".".join(str(r.randint(1, 255)) for _ in range(4))
        planted = [f"{user} [at] {host} [dot] {end}", f"{user} at {host} dot {end}", f"{user}(at){host}.{end}", f"{user} at {host}.{end}", "".join(looks.get(c, c) for c in f"a{user}@{host}.{end}"), "".join(chr(ord(c) + 0xFEE0) for c in f"{user}@{host}.{end}"), spell(phone), spell(ip)][k % 8]
        before, after = (" ".join(r.choice(vocab[:5] if k % 2 else vocab) for _ in range(r.randint(1, 30))) for _ in range(2))
        text = f"{before}, {planted}. {after}"
        at = text.index(planted)
        caught += any(a < at + len(planted) and at < b for own in pii.added(text, pii.detect(text)) for a, b in own)
        clean += not any(map(any, (pii.added(t, pii.detect(t)) for t in (before, after))))
    assert caught >= 0.9 * 800 and clean >= 0.98 * 800


def test_disguises_do_not_depend_on_other_lines():
    r = random.Random(4)
    parts = ["ann", "at", "At", "dot", "[dot]", "(at)", "@", ".", "b.com", "example.org", "one", "two", "point", "plus", "4l5", "-", "\t", "é"]
    other = "[.] one \xa0\n"
    for _ in range(5_000):
        text = " ".join(r.choice(parts) for _ in range(r.randint(1, 9)))
        alone, beside = (pii.added(t, pii.detect(t)) for t in (text, other + text))
        assert [[(a + len(other), b + len(other)) for a, b in own] for own in alone] == beside


@pytest.mark.parametrize("text", ["look at the dot matrix", "we met at noon", "one two three go", "a plain text", "Всё хорошо"])
def test_clean_texts_have_no_spans(text):
    assert not any(pii.added(text, pii.detect(text))) and not any(pii.detect(text))


def test_pii_query(odd, none, odd_rows):
    rows = Counter(tuple(r[:7]) for r in pii.summary(odd).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans").collect())
    expected = Counter()
    for d, t, *_ in odd_rows:
        base = plain_spans(t or "")
        text = pii.listed(base)
        every = pii.listed([sorted(a + b) for a, b in zip(base, pii.added(t or "", base), strict=True)])
        expected[d, *map(len, base), hashlib.sha256(text.encode()).hexdigest(), every] += 1
    assert rows == expected and pii.summary(none).count() == 0
    assert any("[email]" in (r.text or "") for r in pii.redact(odd).collect())


def plain_counts(t):
    words = WORD.findall(t)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rule_counts(odd, none, odd_rows):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = quality_rules.judged(odd)
    rows = judged.collect()
    expected = Counter()
    for d, t, *_ in odd_rows:
        c = plain_counts(t or "")
        expected[d, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]] += 1
    assert Counter(tuple(r[n] for n in names) for r in rows) == expected
    assert all(not r.kept for r in rows if r.base_failed) and quality_rules.judged(none).count() == 0


def test_rule_repeats(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 40))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.n_repeat_words for x in quality_rules.signals(df).collect()}
    assert [got[i] for i in range(200)] == [plain_counts(t)[4] for t in texts]


def odds_of(found, votes):
    return found.base + sum(w[v] for w, v in zip(found.weights, votes, strict=True))


def test_expectation_maximisation_finds_the_bad_class():
    patterns = [((1, 1, 1), 900), ((-1, -1, 1), 40), ((-1, 1, 1), 30), ((1, -1, 1), 30), ((1, 1, 0), 20)]
    found = quality_rules.fitted(patterns, 3)
    assert min(odds_of(found, v) for v in ((1, 1, 1), (1, 1, 0))) > 0 > odds_of(found, (-1, -1, 1))
    assert quality_rules.fitted([], 3).base == 0.0
    assert 0.05 < 1 - found.share < 0.2 and min(found.accuracies()) > 0.5


def test_a_little_corroborated_bad_vote_is_outvoted():
    patterns = [((1, 1, 1, 1, 1), 900), ((-1, 1, 1, 1, 1), 90), ((1, -1, -1, 1, 1), 20), ((1, 1, 1, -1, -1), 20)]
    found = quality_rules.fitted(patterns, 5)
    assert odds_of(found, (-1, 1, 1, 1, 1)) < 0 < odds_of(found, (1, 1, 1, -1, 1))
    assert found.told[3] > 1.5 and found.told[0] < 1.2


def test_expectation_maximisation_document_by_document():
    """The estimates from counts of patterns are those of a plain version that goes through all documents."""
    r = random.Random(12)
    docs = [tuple(r.choice((1, 1, 1, 0, -1)) if r.random() < 0.3 else 1 for _ in range(4)) for _ in range(300)] + [(-1, -1, 1, 0)] * 60
    found = quality_rules.fitted(sorted(Counter(docs).items()), 4)
    votes, good, trust = (-1, 0, 1), [0.1 if -1 in d else 0.95 for d in docs], quality_rules.TRUST
    for _ in range(quality_rules.ROUNDS):
        share = quality_rules.TRUST_SHARE * quality_rules.EXPECTED_SHARE + (1 - quality_rules.TRUST_SHARE) * sum(good) / len(good)
        mass = [[1 - g for g in good], good]
        own = [[[sum(m for m, d in zip(mass[c], docs, strict=True) if d[j] == v) / sum(mass[c]) for v in votes] for j in range(4)] for c in (0, 1)]
        chances = [[[trust[c] * quality_rules.EXPECTED[c][k] + (1 - trust[c]) * own[c][j][k] for k in range(3)] for j in range(4)] for c in (0, 1)]
        cov = lambda j, k: sum(m * ((d[j] == -1) - own[c][j][0]) * ((d[k] == -1) - own[c][k][0]) for c in (0, 1) for m, d in zip(mass[c], docs, strict=True))  # noqa: B023, E731
        told = [1 + sum(max(0.0, cov(j, k) / (cov(j, j) * cov(k, k)) ** 0.5) for k in range(4) if k != j) for j in range(4)]
        odds = [math.log(share / (1 - share)) + sum(math.log(chances[1][j][d[j] + 1] / chances[0][j][d[j] + 1]) / told[j] for j in range(4)) for d in docs]
        new = [1 / (1 + math.exp(-o)) for o in odds]
        good, settled = new, max(abs(a - b) for a, b in zip(new, good, strict=True)) < 1e-9
        if settled:
            break
    assert max(abs(odds_of(found, d) - o) for d, o in zip(docs, odds, strict=True)) < 1e-3


def test_verdict_is_not_all_must_pass(spark):
    """A document in capitals, which one rule finds bad, is kept; one full of signs isn't."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    r = random.Random(13)
    vocab = ["reading", "the", "terms", "of", "use", "before", "this", "permit", "holds", "under", "law"]
    prose = "\n".join(" ".join(r.choice(vocab) for _ in range(12)) for _ in range(8))
    new = spark.createDataFrame([(-1, prose.upper()), (-2, prose), (-3, " ".join(w + "#*$" for w in prose.split()))], "doc_id long, text string")
    votes = {x.doc_id: x.few_capitals for x in quality_rules.signals(new).select("doc_id", quality_rules.rules()["few_capitals"].alias("few_capitals")).collect()}
    kept = {x.doc_id: x.kept for x in quality_rules.judged(docs.unionAll(new)).filter("doc_id < 0").collect()}
    assert votes[-1] == -1 and kept == {-1: True, -2: True, -3: False}
    report = {x.rule: x for x in quality_rules.report(docs).collect()}
    assert set(report) == set(quality_rules.rules()) and all(0.5 < x.accuracy <= 1 and x.bad_if_good < x.bad_if_bad for x in report.values())


def test_avi_round_trip_and_shots():
    r = random.Random(2)
    payloads = [bytes(r.choice([0, 255, r.randrange(256)]) for _ in range(576 * r.randint(1, 4))) for _ in range(60)]
    files = avi.stored(payloads)
    assert [f.tobytes() for f in avi.read_back(files)] == payloads
    assert files[0][:4] == b"RIFF" and files[0][8:12] == b"AVI "
    calm, wild = bytes(576), bytes(range(256)) * 2 + bytes(64)
    assert avi.shots(avi.read_back(avi.stored([calm * 5 + wild * 5]))[0]) == [(0, 5), (5, 10)]
    with pytest.raises(ValueError, match="beyond the file"):
        avi.riff(files[0][: len(files[0]) // 2])


def coded_jpeg(planes, sampling, steps, shape, restart=0):
    """A baseline JPEG with codes of 8 bits for all symbols, and the samples that its coefficients stand for."""
    zigzag = [0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28, 35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63]
    wave = np.array([[(0.5 if u else 8**-0.5) * math.cos((2 * x + 1) * u * math.pi / 16) for u in range(8)] for x in range(8)])
    symbols = [r << 4 | n for r in range(16) for n in range(12) if n or r in (0, 15)][::-1]
    bits = lambda v, n: format(v, f"0{n}b") if n else ""
    number = lambda v: (abs(v).bit_length(), bits(v if v > 0 else v + (1 << abs(v).bit_length()) - 1, abs(v).bit_length()))
    seen, before, pieces, out = [np.zeros(p.shape) for p in planes], [0] * len(planes), [], ""

    def block(i, y, x):
        table = np.array(steps)
        found = wave.T @ (planes[i][y : y + 8, x : x + 8] - 128.0) @ wave
        quantised = np.rint(found.ravel()[zigzag] / table).astype(int)
        back = np.zeros(64)
        back[zigzag] = quantised * table
        seen[i][y : y + 8, x : x + 8] = wave @ back.reshape(8, 8) @ wave.T + 128
        size, extra = number(int(quantised[0]) - before[i])
        before[i] = int(quantised[0])
        code, run = bits(symbols.index(size), 8) + extra, 0
        last = max(np.flatnonzero(quantised[1:]).tolist(), default=-1) + 1
        for v in quantised[1 : last + 1].tolist():
            if v == 0:
                run += 1
                continue
            while run > 15:
                code, run = code + bits(symbols.index(0xF0), 8), run - 16
            size, extra = number(v)
            code, run = code + bits(symbols.index(run << 4 | size), 8) + extra, 0
        return code + (bits(symbols.index(0), 8) if last < 63 else "")

    down, across = max(s[0] for s in sampling), max(s[1] for s in sampling)
    units = [(r, c) for r in range(-(-shape[0] // (8 * down))) for c in range(-(-shape[1] // (8 * across)))]
    for k, (r, c) in enumerate(units):
        if restart and k and k % restart == 0:
            pieces, out, before = [*pieces, out], "", [0] * len(planes)
        out += "".join(block(i, 8 * (r * s[0] + a), 8 * (c * s[1] + b)) for i, s in enumerate(sampling) for a in range(s[0]) for b in range(s[1]))
    data = b""
    for k, piece in enumerate([*pieces, out]):
        piece += "1" * (-len(piece) % 8)
        data += (bytes([0xFF, 0xD0 + (k - 1) % 8]) if k else b"") + bytes(int(piece[i : i + 8], 2) for i in range(0, len(piece), 8)).replace(b"\xff", b"\xff\x00")
    part = lambda kind, body: bytes([0xFF, kind]) + struct.pack(">H", len(body) + 2) + body
    codes = bytes([0] * 7 + [len(symbols)] + [0] * 8) + bytes(symbols)
    head = part(0xFE, b"a comment") + part(0xDB, b"\x12" + struct.pack(">64H", *steps)) + (part(0xDD, struct.pack(">H", restart)) if restart else b"")
    head += part(0xC0, struct.pack(">BHHB", 8, *shape, len(planes)) + b"".join(bytes([i + 1, s[1] << 4 | s[0], 2]) for i, s in enumerate(sampling)))
    head += part(0xC4, b"\x01" + codes + b"\x13" + codes) + part(0xDA, bytes([len(planes)]) + b"".join(bytes([i + 1, 0x13]) for i in range(len(planes))) + b"\0\x3f\0")
    return b"\xff\xd8" + head + data + b"\xff\xd9", [np.clip(np.rint(x), 0, 255) for x in seen]


@pytest.mark.parametrize("restart", [0, 1, 3])
@pytest.mark.parametrize("sampling", [[(1, 1)], [(2, 2), (1, 1), (1, 1)], [(1, 2), (1, 1)]])
def test_jpeg_with_tables_of_its_own(sampling, restart):
    random, steps = np.random.default_rng(4), [3 + k // 4 for k in range(64)]
    planes = [random.integers(0, 256, (32 // max(s[0] for s in sampling) * s[0], 48 // max(s[1] for s in sampling) * s[1])) for s in sampling]
    coded, seen = coded_jpeg(planes, sampling, steps, (32, 48), restart)
    got = jpeg.decoded(coded)
    assert [np.abs(g - s).max() <= 1 for g, s in zip(got, seen, strict=True)] == [True] * len(planes)
    assert np.mean([np.mean(g == s) for g, s in zip(got, seen, strict=True)]) > 0.999
    for wrong, why in ((coded[:-40], "."), (coded.replace(b"\xff\xc0", b"\xff\xc2"), "baseline"), (coded.replace(b"\xff\xdb", b"\xff\xe1"), "isn't defined"), (b"GIF", "no JPEG")):
        with pytest.raises(ValueError, match=why):
            jpeg.decoded(wrong)


def test_avi_frames_of_other_writers():
    """Comments, other quantisers and other codes are followed; frames of another size are refused."""
    values = np.random.default_rng(5).integers(90, 160, 576).astype(np.uint8)
    frame = avi.read_frames(avi.stored([values.tobytes()])[0])[0]
    comment = frame[:2] + b"\xff\xfe\x00\x04hi" + frame[2:]
    twice = frame.replace(bytes([8]) + bytes([1]) * 63, bytes([16]) + bytes([1]) * 63)
    flat = np.kron(values.reshape(24, 24), np.ones((8, 8)))
    other, _ = coded_jpeg([flat], [(1, 1)], [8] * 64, (192, 192), 5)
    got = avi.read_back([avi.avi([frame, comment, twice, other])])[0]
    assert (got == [values, values, np.clip(2 * values.astype(int) - 128, 0, 255), values]).all()
    small, _ = coded_jpeg([flat[:64, :64]], [(1, 1)], [8] * 64, (64, 64))
    with pytest.raises(ValueError, match="blocks"):
        avi.read_back([avi.avi([small])])


def test_avi_query(odd, none, odd_rows):
    rows = avi.summary(odd).collect()
    assert len(rows) == len(odd_rows) and avi.summary(none).count() == avi.clips(none).count() == 0
    by = {(r.doc_id, r.n_bytes): r for r in rows}
    for d, t, *_ in odd_rows:
        payload, n = avi.padded(t)
        x = by[d, n]
        assert len(payload) % 576 == 0 and len(payload) > 0
        assert (x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert by[1, 0].payload_bytes == 576
    ends = {(r.doc_id, r.clip): r for r in avi.clips(odd).filter("doc_id = 4").collect()}
    assert ends[4, 0].start_s == 0 and sum(r.n_frames for r in ends.values()) == by[4, len(odd_rows[3][1].encode())].payload_bytes // 576


def test_bpe_equals_library_on_code_points_of_all_planes(library):
    points = [c for c in [*range(1, 0x3100), *range(0xA000, 0xD800, 3), *range(0xF900, 0x20000, 3), *range(0x20000, 0xE0100, 997)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)} {chr(c)}z" for c in points]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert bpe.vocabulary(bpe.VOCABULARY).encode_batch(texts) == expected
