"""Operators over whole corpora, against plain versions, and the pipeline."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from gridloom.llm import common, line_dedup, mixing, quality_model, quality_rules, queries, quotes, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(values):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    order = sorted(parent)
    for i, a in enumerate(order):
        for b in order[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in order}


def test_simhash_query(odd, none, odd_rows):
    rows = simhash.summary(odd).collect()
    prints = [plain_fingerprint(t or "") for _, t, *_ in odd_rows]
    root = plain_components(prints)
    least = {}
    for (d, *_), p in zip(odd_rows, prints, strict=True):
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    expected = Counter((d, f"{p:016x}", least.get(root[p])) for (d, *_), p in zip(odd_rows, prints, strict=True))
    assert Counter(map(tuple, rows)) == expected and simhash.summary(none).count() == 0


def nodes_of(spark, values):
    return spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")


@pytest.mark.parametrize("block", [4, 512])
def test_simhash_links_lose_nothing(spark, monkeypatch, block):
    """Chains and a dense group of near values, in small and large blocks."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(5)
    values = {r.getrandbits(64) for _ in range(150)}
    for v in list(values)[:20]:
        for _ in range(8):
            v ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 5)))
            values.add(v)
    centre = r.getrandbits(64)
    values |= {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    values = sorted(values)
    found = simhash.components(simhash.links(nodes_of(spark, values))).collect()
    got = {x.node % 2**64: x.root % 2**64 for x in found}
    expected = plain_components(values)
    group = lambda roots: {frozenset(v for v in values if roots.get(v, v) == x) for x in values} - {frozenset()}
    assert group(got) == group(expected)


def test_pigeonhole_thresholds_cover():
    r = random.Random(6)
    both = np.zeros((64, 64)) + 250.0
    np.fill_diagonal(both, 500.0)
    for total in (10, 10**5, 10**7, 10**9):
        parts, thresholds = simhash.allocated(total, both * total / 1000)
        assert sorted(b for p in parts for b in p) == list(range(64))
        assert sum(thresholds) == simhash.MAX_BITS - len(parts) + 1
        masks = [m % 2**64 for m in simhash.signature_masks(parts, thresholds)]
        for _ in range(20):
            flips = sum(1 << b for b in r.sample(range(64), 4))
            assert any(not m & flips for m in masks)


def test_simhash_representatives(odd, odd_rows):
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    prints = {t: plain_fingerprint(t or "") for _, t, *_ in odd_rows}
    root = plain_components(prints.values())
    rows = kept.collect()
    assert len(rows) == len(set(root.values())) and {root[prints[x.text]] for x in rows} == set(root.values())
    ids = [x.doc_id for x in rows]
    assert 60 in ids and 61 not in ids and ids.count(5) == 2


def test_simhash_representatives_of_null_and_shared_ids(spark):
    texts = [" ".join(f"{k}{i}" for i in range(40)) for k in "abcd"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (3, texts[2]), (5, texts[2]), (5, texts[3]), (None, texts[2]), (None, None), (None, "")]
    kept = simhash.representatives(spark.createDataFrame([(*x, k) for k, x in enumerate(rows)], "doc_id long, text string, `a.b` int")).collect()
    assert len(kept) == 5 and (None, texts[1], 1) in [tuple(x) for x in kept]
    found = [(x.doc_id, x.text or "") for x in kept]
    assert sorted(found, key=str) == sorted([(None, texts[0]), (None, texts[1]), (3, texts[2]), (5, texts[3]), (None, "")], key=str)


def plain_line_dedup(rows, least):
    seen, gone = {}, [set() for _ in rows]
    split = [t.split("\n") for _, t in rows]
    wordy = [[k for k, x in enumerate(ls) if WORD.search(x)] for ls in split]
    for i in sorted(range(len(rows)), key=lambda i: rows[i][0]):
        for s in range(len(wordy[i])):
            total = 0
            for e in range(s, min(len(wordy[i]), s + least)):
                total += len(WORD.findall(split[i][wordy[i][e]]))
                if total >= least:
                    run = tuple(split[i][k] for k in wordy[i][s : e + 1])
                    if run in seen:
                        gone[i].update(wordy[i][s : e + 1])
                    else:
                        seen[run] = i
    return {rows[i][0]: ("\n".join(x for k, x in enumerate(split[i]) if k not in gone[i]) if gone[i] else rows[i][1], len(gone[i])) for i in range(len(rows))}


def test_line_dedup(spark):
    r = random.Random(5)
    lines = ["a b c", "d e f g h i j k l m n", "x", "y y", "hello there you all", "", "  ", "z z z z z"]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(0, 9)))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id: (x.text, x.n_deleted) for x in line_dedup.deduplicated(df).collect()} == plain_line_dedup(rows, line_dedup.MIN_WORDS)


def plain_runs(sequences):
    """(document, at, length) of the maximal runs that occur at an earlier place too, by a suffix array that is sorted whole."""
    places = [(d, i) for d, s in enumerate(sequences) for i in range(len(s))]
    array = sorted(places, key=lambda p: sequences[p[0]][p[1] :])

    def common(p, q):
        n = 0
        for x, y in zip(sequences[p[0]][p[1] :], sequences[q[0]][q[1] :], strict=False):
            if x != y:
                break
            n += 1
        return n

    longest = {}
    for k, p in enumerate(array):
        best = 0
        for step in (-1, 1):  # the least common prefix on the way to a neighbour only falls
            shared, j = 10**9, k
            while 0 <= j + step < len(array) and shared > best:
                shared = min(shared, common(array[j], array[j + step]))
                j += step
                if array[j] < p:
                    best = max(best, shared)
        longest[p] = best
    ends = {}
    for (d, i), n in sorted(longest.items()):
        if n:
            ends.setdefault((d, i + n), i)
    return {(d, i, e - i) for (d, e), i in ends.items()}


@pytest.mark.parametrize("same_hash", [None, "first_hash"])
def test_line_runs_are_those_of_a_suffix_array(spark, monkeypatch, same_hash):
    """Also where all lines have the same first hash."""
    if same_hash:
        monkeypatch.setattr(line_dedup, same_hash, lambda value: line_dedup.F.lit(7).cast("long"))
    r = random.Random(11)
    parts = [[r.choice("abcd") for _ in range(r.randint(1, 12))] for _ in range(8)]
    sequences = [[x for _ in range(r.randint(0, 4)) for x in r.choice(parts)] for _ in range(40)] + [["a"] * 13, ["a"] * 30]
    sequences = [s for k, s in enumerate(sequences) if s and s not in sequences[:k]]
    df = spark.createDataFrame([(d, "\n".join(s)) for d, s in enumerate(sequences)], "doc_id long, text string")
    runs, copies = line_dedup.repeated_runs(df, 1)
    assert {(x.doc_id, x["at"], x.length) for x in runs.collect()} == plain_runs(sequences) and copies.count() == 0


def test_whole_copies_of_lines(spark):
    long, short = "one two three four five six\n\nseven eight nine ten", "too short\nto count"
    rows = [(4, long), (2, long), (2, long.replace("\n\n", "\n \n")), (None, long), (3, short), (1, short), (5, "new\n" + long)]
    got = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x.doc_id, x.text, x.n_deleted) for x in got} == {(None, long, 0), (2, "", 2), (2, " ", 2), (4, "", 2), (3, short, 0), (1, short, 0), (5, "new\n", 2)}


def test_line_dedup_odd_rows(odd, none, odd_rows):
    out = line_dedup.deduplicated(odd)
    assert set(odd.columns) <= set(out.columns) and out.count() == len(odd_rows)
    by = {}
    for x in out.collect():
        by.setdefault(x.doc_id, []).append(x)
    assert by[1][0].text is None and by[2][0].text == "" and by[60][0].n_deleted == 0
    assert [(x.text, x.n_deleted) for i in range(61, 80) for x in by[i]] == [("", 2)] * 19
    assert [x.n_deleted for x in by[5]] == [0, 0, 0]
    assert line_dedup.deduplicated(none).count() == line_dedup.remaining(none).count() == 0
    assert line_dedup.remaining(odd).columns == odd.columns


def test_exponent():
    tokens = [1000, 100, 100, 50]
    a = mixing.exponent(tokens, entropy=0.9, max_repeats=1e9)
    w = np.array(tokens) ** a
    w = w / w.sum()
    assert -(w * np.log(w)).sum() / np.log(4) == pytest.approx(0.9, abs=1e-6)
    limited = mixing.exponent(tokens, entropy=0.99, max_repeats=3.0)
    assert (1000 / 50) ** (1 - limited) == pytest.approx(3.0, abs=1e-6)
    assert mixing.exponent([5]) == mixing.exponent([]) == mixing.exponent([0, 0]) == 1.0


def test_mixing_meets_its_targets(spark):
    r = random.Random(9)
    rows = [(i, " ".join("w" for _ in range(r.randint(1, 30))), "big" if i % 3 else f"s{i % 9}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    slim = mixing.slim_of(df).toPandas()
    sums = slim.groupby(mixing.SOURCE).tokens.sum().to_dict()
    want = mixing.targets(sums)
    out = mixing.schedule(df, block_tokens=5000).toPandas()
    for s, group in slim.groupby(mixing.SOURCE):
        full, rest = divmod(want[s], sums[s])
        fits = group.groupby(mixing.PLACE).tokens.sum().sort_index().cumsum()
        expected = full * len(group) + group[mixing.PLACE].isin(fits.index[fits <= rest]).sum()
        assert (out.source == s).sum() == expected
    assert set(out.doc_id) == set(range(3000))
    shares = out.groupby(["block", "source"]).n_tokens.sum().unstack()
    assert (shares.sum(axis=1) > 3000).all() and shares["big"].std() / shares["big"].mean() < 0.3
    part = mixing.schedule(df, budget=10_000)
    assert 9000 < part.agg({"n_tokens": "sum"}).first()[0] <= 10_000


def test_mixing_odd_rows(odd, none, odd_rows):
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and out.count() >= len(odd_rows)
    assert mixing.schedule(odd).count() == out.count() and mixing.schedule(none).count() == mixing.mixed(none).count() == 0


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there, can you help me today?\nSecond line of it.\n\nAnother paragraph here."),
        (1, 1, "assistant", "On Monday, Bob wrote:\n> Hello there,  can you HELP me today?\n> Second line of it.\n\nSure, I can."),
        (1, 2, "user", "Unrelated new message."),
        (1, 3, "user", "> > Another paragraph here.\n> Sure, I can.\nThanks a lot to you"),
        (1, 4, "assistant", ">Unrelated new message.\nok\n"),
        (1, 5, "user", "> Thanks a lot to you\n\nfine"),
        (2, 0, "user", "> Sure, I can.\nno link"),
        (None, 1, None, None),
        (None, None, "x", ""),
        (1, 2, "user", "Unrelated new message."),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'clash' as key", "'clash' as root")
    got = {(r.conv_id, r.turn): (r.text, r.parent_turn, r.root_turn, r.depth) for r in quotes.threads(df).collect()}
    assert got == {
        (1, 0): (rows[0][3], None, 0, 0),
        (1, 1): ("Sure, I can.", 0, 0, 1),
        (1, 2): ("Unrelated new message.", None, 2, 0),
        (1, 3): ("Thanks a lot to you", 1, 0, 2),
        (1, 4): ("ok", 2, 2, 1),
        (1, 5): ("fine", 3, 0, 3),
        (2, 0): ("no link", None, 0, 0),
        (None, 1): ("", None, 1, 0),
        (None, None): ("", None, None, 0),
    }
    assert quotes.threads(df.limit(0)).count() == 0


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality_model.summary(docs, labels).join(labels, "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.predicted == held.quality).mean() > 0.93 and out.score.between(0, 1).all()
    good = held[held.quality == 1]
    assert good.predicted.mean() > 0.97


def test_contexts_are_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "PAIRS", 7)
    texts = ["a b c d a a", "", "one", None, "zebra Yak zebra 9 x " * 5, "b a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    index = quality_model.index_vectors().astype(float)
    total = np.zeros_like(index)
    for t in texts:
        packed = quality_model.rows_of(t)
        for own in (packed % quality_model.ROWS, packed // quality_model.ROWS):
            np.add.at(total, own[1:], index[own[:-1]])
            np.add.at(total, own[:-1], index[own[1:]])
    expected = index + total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    assert np.allclose(quality_model.fit(docs, labels).vectors, expected, atol=1e-5)


def test_classifier_odd_rows(spark, odd, none, odd_rows):
    labels = spark.createDataFrame([(d, i % 2) for i, d in enumerate(range(10, 60))] + [(10, 0), (None, 1), (11, None)], "doc_id long, quality int")
    out = quality_model.summary(odd, labels)
    assert out.count() == len(odd_rows)
    assert quality_model.summary(odd, labels.limit(0)).filter("score <> 0.5").count() == 0
    assert quality_model.summary(none, labels).count() == 0
    assert quality_model.accepted(odd, labels).columns == odd.columns


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11)) and set(queries.ORACLES) <= set(queries.QUERIES)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "mixing", "bpe"]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL).cache()
        assert name == "bpe" or docs.columns == before.columns
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] <= counts[4] == counts[5]
    assert corpus_pipeline.run(spark, SMALL).count() == counts[-1]
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quotes_sql(spark):
    """The SQL beside op7 also holds where messages quote."""
    import duckdb

    from gridloom.llm.oracles import ORACLES

    rows = [
        (1, 0, "u", "Hello there, can you help me today?\nSecond line of it.\n\nAnother paragraph here."),
        (1, 1, "a", "On Monday, Bob wrote:\n\n> Hello there,  can you HELP me today?\n> Second line of it.\n\nSure, I can.\n"),
        (1, 2, "u", "> > Another paragraph here.\n> Sure, I can.\nThanks a lot to you"),
        (1, 3, "a", "He wrote:\nnothing quoted"),
        (2, 0, "u", "> Sure, I can.\nno link"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    names = ["conv_id", "turn", "role", "text", "parent_turn", "root_turn", "depth"]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    expected = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES['op7_quotes']})").fetchall())
    assert sorted(tuple(r[n] for n in names) for r in quotes.threads(df).collect()) == expected


@pytest.mark.parametrize("name", ["op2_mixing", "op7_quotes", "op9_line_dedup", "op10_quality_rules"])
def test_native_operators_run_no_python(spark, monkeypatch, name):
    """Also in the plans of what they write on the way."""
    plans, written = [], common.checkpointed

    def recorded(df):
        plans.append(df._jdf.queryExecution().toString())
        return written(df)

    for module in (common, mixing, quotes, line_dedup, quality_rules):
        if hasattr(module, "checkpointed"):
            monkeypatch.setattr(module, "checkpointed", recorded)
    plans.append(queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString())
    assert len(plans) > 1 and any("documents.parquet" in p or "conversations.parquet" in p for p in plans)
    assert not any(re.search("Python|Pandas|InArrow|CartesianProduct", p) for p in plans)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, odd, none, odd_rows, name, stage):
    """Nulls, empty and very long texts, ties, repeated rows, clashing names and empty tables, in each stage by itself."""
    out, empty = stage(spark, odd, SMALL), stage(spark, none, SMALL)
    assert empty.count() == 0 and (name == "bpe" or out.columns == empty.columns == odd.columns)
    ids = Counter(x.doc_id for x in out.select("doc_id").collect())
    given = Counter(d for d, *_ in odd_rows)
    assert set(ids) <= set(given) and (name == "mixing" or not ids - given)
    if name in ("mixing", "bpe"):
        assert not given - ids
