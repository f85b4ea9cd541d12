"""Repeated runs of lines, found in a suffix array and deleted but for their first copy; DataFrame operations only.

The lines with a word are a sequence of line ids (two hashes of 64 bits with different seeds), one sequence per document.
Documents of equal sequences form one class from the start: only their first goes on, the others are wholly copies of it.

Suffix array: prefix doubling, three doublings a round, ranks the suffixes by their first 1, 8, 64, ... lines.  A rank comes
from sorting the distinct tuples of the ranks of the eighths, so it's exact and in order: the suffixes of one rank are an
interval of the suffix array whose common prefix has that length at least.  A suffix alone in its interval leaves, so there
are rounds as long as something repeats.

Longest common prefixes: for each place the longest prefix that an earlier place has too is found by descent through the
rounds, from long to short: intervals are split by the rank of what follows them, and a place that isn't the first of its
part moves on into it, while the first of a part stays behind as its representative.  The lengths so found are the maximal
repeated runs: of those that end at one line, the longest counts.  A run counts if it has MIN_WORDS words, and its lines go.

Defined results: the first copy, by doc_id (null first), then text hash, then line, stays; lines without a word are kept
and don't part a run; a document that loses nothing keeps its text as it is, a null text stays null and an empty one empty;
rows of equal doc_id and text count as one place and lose the same lines; a very long text is one row in one task where it's
split and put together, and a row for each line in between; an empty table gives no rows; further columns are carried along
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm import common

MIN_WORDS = 10
#: Ranks that make one of the next round: fewer rounds, each of which writes its ranks, for wider keys.
TUPLE = 8
#: Names of the columns that the operator adds for its own use.
KEY, ID, DELETED, WHOLE = "__line_key", "__line_id", "__deleted_lines", "__whole"
WORD = "[^ \\t-\\r]+"
#: Seeds the second hash of a line and of a sequence of lines.
SALT = "second"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def key_of(docs: DataFrame) -> Column:
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use of a value that is computed once: a column that a lambda names would be put in its place, and computed for each element."""
    return F.transform(F.array(value), use)[0]


def words_up_to(line: Column, most: int) -> Column:
    """The number of words of a line that has one; from most on, any number from there on: only that much of the line is split."""
    # Possessive, so that a line is read once; most lines need no more.
    many = line.rlike("\\A[ \\t-\\r]*+(?:[^ \\t-\\r]++[ \\t-\\r]++){%d}[^ \\t-\\r]" % max(most - 1, 0))
    return F.when(many, most).otherwise(F.size(F.split(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), "[ \t-\r]+", most + 1)))


def first_hash(value: Column) -> Column:
    return F.xxhash64(value)


def second_hash(value: Column) -> Column:
    return F.xxhash64(F.lit(SALT), value)


def sequences(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, key, two hashes of the sequence of lines with a word, and that sequence: two hashes and the number of words of each line."""
    wordy = F.filter(lines_of(docs["text"]), lambda x: x.rlike(WORD))
    lines = F.transform(wordy, lambda x: F.struct(first_hash(x).alias("a"), second_hash(x).alias("b"), words_up_to(x, min_words).alias("n")))
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), key_of(docs).alias("key"), lines.alias("lines"))
    return own.select("doc_id", "key", F.xxhash64("lines").alias("seq_a"), F.xxhash64(F.lit(SALT), "lines").alias("seq_b"), "lines")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """df with the column number: 0, 1, 2, ... in that order.  A number for each partition is gathered, none for each row."""
    placed = common.checkpointed(df.orderBy(*order).withColumn("number", F.monotonically_increasing_id()))
    part = F.shiftright("number", 33).cast("int")
    sizes = {r["part"]: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    before = [sum(n for p, n in sizes.items() if p < k) for k in range(max(sizes, default=0) + 1)]
    return placed.withColumn("number", F.get(F.lit(before).cast("array<bigint>"), part) + F.col("number").bitwiseAND((1 << 33) - 1))


def ranked(df: DataFrame, *name: str, ordered: bool = True) -> DataFrame:
    """name columns, first, rank: the names that two rows or more have, with the first place that has them and their rank, in order or just a number of their own."""
    found = df.groupBy(*name).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    # Written before it's joined, so that the join can split the partition of a name that very many rows have.
    found = found.orderBy(*name) if ordered else found
    return common.checkpointed(found.select(*name, "first", F.monotonically_increasing_id().alias("rank")))


def level(named: DataFrame, size: int, width: int) -> DataFrame:
    """named (pos, rank, first, ...; ranks by the next size lines) and names: the rank and those that follow it size, 2 * size, ... lines on, TUPLE at most, up to a gap."""
    row = Window.partitionBy(F.expr(f"pos div {width}")).orderBy("pos")
    on = [F.col("rank"), *[F.first("rank").over(row.rangeBetween(k * size, k * size)) for k in range(1, TUPLE)]]
    df = named.withColumns({f"on{k}": x for k, x in enumerate(on)})
    together = F.coalesce(*[F.when(F.col(f"on{k}").isNull(), k) for k in range(1, TUPLE)], F.lit(TUPLE))
    return common.checkpointed(df.select(*named.columns, F.slice(F.array(*[f"on{k}" for k in range(TUPLE)]), 1, together).alias("names")))


def intervals(places: DataFrame, width: int) -> list[DataFrame]:
    """By round k, of every place that shares its next TUPLE^k lines with another: pos, rank by these lines, the first such place and names; in round 0 also the line's words."""
    named = places.join(ranked(places, "a", "b"), ["a", "b"]).select("pos", "rank", "first", "n")
    rounds = [level(named, 1, width)]
    while True:
        whole = rounds[-1].filter(F.size("names") == TUPLE).select("pos", "names")
        longer = ranked(whole, "names")
        if longer.isEmpty():
            return rounds
        rounds.append(level(whole.join(longer, "names").select("pos", "rank", "first"), TUPLE ** len(rounds), width))


def longest(rounds: list[DataFrame]) -> DataFrame:
    """pos, len of every place whose line occurs earlier: the length of its longest prefix that occurs at an earlier place.

    A row of state is a place of an interval (len, interval); those that don't seek only stand for the earlier places.
    Each interval has one of these at most, so there are at most two rows for a place.
    """
    state = None
    for k in reversed(range(len(rounds))):
        inside = rounds[k].filter("pos > first").select("pos", "rank", "first")
        if k + 1 < len(rounds):
            further = rounds[k + 1].select("pos", F.col("first").alias("later"))
            inside = inside.join(further, "pos", "left").filter("later is null or later = pos")
        size = TUPLE**k
        length = F.lit(size).cast("long").alias("len")
        seeking = inside.select("pos", length, F.col("rank").alias("interval"), F.lit(True).alias("seeks"))
        standing = inside.select(F.col("first").alias("pos"), length, F.col("rank").alias("interval"), F.lit(False).alias("seeks")).distinct()
        entering = seeking.unionAll(standing)
        state = entering if state is None else state.unionAll(entering)

        there = rounds[k].select(F.col("pos").alias("on"), F.slice("names", 1, TUPLE - 1).alias("names"))
        state = common.checkpointed(state.withColumn("on", F.col("pos") + F.col("len")).join(there, "on", "left").drop("on"))
        longer = state.filter("names is not null").select("pos", "len", "interval", F.explode(F.transform(F.sequence(F.lit(1), F.size("names")), lambda m: F.slice("names", 1, m))).alias("part"))  # noqa: B023
        parts = ranked(longer, "len", "interval", "part", ordered=False)
        step = (F.size("part") * size).alias("step")
        held = longer.join(parts, ["len", "interval", "part"]).filter("pos > first").select("pos", "len", "interval", step, "rank", "first")
        # Of the parts that a place isn't the first of, the one with the longest prefix.
        moved = common.checkpointed(held.groupBy("pos", "len", "interval").agg(F.max("step").alias("step"), F.max_by("rank", "step").alias("rank"), F.max_by("first", "step").alias("first")))
        to = (F.col("len") + F.coalesce("step", F.lit(0))).alias("len")
        after = state.join(moved, ["pos", "len", "interval"], "left").select("pos", to, F.coalesce("rank", "interval").alias("interval"), "seeks")
        stays = moved.select(F.col("first").alias("pos"), to, F.col("rank").alias("interval"), F.lit(False).alias("seeks")).distinct()
        state = after.unionAll(stays)
    return state.filter("seeks").select("pos", "len")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """The maximal repeated runs (doc_id, key, at, length, words; later than another copy) and the documents (doc_id, key) that are copies as a whole.

    Runs are of the first documents of each sequence of lines; both have min_words words at least, of a line min_words count at most.
    """
    own = common.checkpointed(sequences(docs, min_words).filter(F.size("lines") > 0))
    firsts = own.groupBy("seq_a", "seq_b").agg(F.min(F.struct("doc_id", "key", "lines")).alias("of"))
    texts = numbered(firsts.select("seq_a", "seq_b", "of.*"), "doc_id", "key")

    enough = F.aggregate("lines", F.lit(0).cast("long"), lambda s, x: s + x["n"]) >= min_words
    of = texts.select("seq_a", "seq_b", F.col("doc_id").alias("first_id"), F.col("key").alias("first_key"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key"))
    copies = own.filter(enough).select("doc_id", "key", "seq_a", "seq_b").join(of, ["seq_a", "seq_b"]).filter(~same).select("doc_id", "key").distinct()

    # Lines have places in one row of all documents; between two documents there's a place without a line.
    width = 1 + (texts.agg(F.max(F.size("lines"))).first()[0] or 0)
    places = texts.select("number", F.posexplode("lines").alias("at", "line")).select((F.col("number") * width + F.col("at")).alias("pos"), "line.a", "line.b", F.col("line.n").cast("long").alias("n"))
    rounds = intervals(places, width)
    runs = longest(rounds).groupBy((F.col("pos") + F.col("len")).alias("end")).agg(F.min("pos").alias("pos"))

    number = F.expr(f"pos div {width}")
    words = rounds[0].select("pos", "n", F.sum("n").over(Window.partitionBy(number).orderBy("pos")).alias("upto"))
    begin = words.select("pos", (F.col("upto") - F.col("n")).alias("before"))
    close = words.select((F.col("pos") + 1).alias("end"), "upto")
    runs = runs.join(begin, "pos").join(close, "end").withColumn("words", F.col("upto") - F.col("before")).filter(F.col("words") >= min_words)
    runs = common.checkpointed(runs.select(number.alias("number"), F.expr(f"cast(pos % {width} as int)").alias("at"), (F.col("end") - F.col("pos")).cast("int").alias("length"), "words"))
    return runs.join(texts.select("number", "doc_id", "key"), "number").select("doc_id", "key", "at", "length", "words"), copies


def deletions(docs: DataFrame, min_words: int) -> DataFrame:
    """KEY and ID of the documents that lose lines, the lines (among those with a word) that go, and whether all of them do."""
    runs, copies = repeated_runs(docs, min_words)
    # Runs that end later don't begin earlier, so each adds what lies behind the end of the one before.
    row = Window.partitionBy("key", "doc_id").orderBy("at")
    end = F.col("at") + F.col("length")
    runs = runs.withColumn("from", F.greatest("at", F.coalesce(F.lag(end).over(row), F.lit(0))))
    own = runs.groupBy("key", "doc_id").agg(F.flatten(F.collect_list(F.sequence("from", end - 1))).alias(DELETED))
    whole = copies.select("key", "doc_id", F.array().cast("array<int>").alias(DELETED), F.lit(True).alias(WHOLE))
    return own.withColumn(WHOLE, F.lit(False)).unionAll(whole).withColumnsRenamed({"key": KEY, "doc_id": ID})


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs without later copies of repeated runs of lines; with the columns n_lines and n_deleted behind its own."""
    gone = common.checkpointed(deletions(docs, min_words))
    keyed = docs.withColumn("__key", key_of(docs))
    df = keyed.join(gone, (keyed["__key"] == gone[KEY]) & keyed["doc_id"].cast("long").eqNullSafe(gone[ID]), "left")
    lines, deleted, whole = lines_of(F.col("text")), F.col(DELETED), F.coalesce(WHOLE, F.lit(False))

    def kept(own: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(own) - 1)
        left = lambda wordy: F.array_except(every, F.transform(deleted, lambda at: F.get(wordy, at)))
        return F.array_join(F.transform(bound(F.filter(every, lambda i: F.get(own, i).rlike(WORD)), left), lambda i: F.get(own, i)), "\n")

    wordless = F.array_join(F.filter(lines, lambda x: ~x.rlike(WORD)), "\n")
    text = F.when(deleted.isNull(), F.col("text")).when(whole, wordless).otherwise(bound(lines, kept))
    n_lines = F.size(F.filter(lines, lambda x: x.rlike(WORD))).cast("long")
    n_deleted = F.when(whole, n_lines).otherwise(F.coalesce(F.size(deleted), F.lit(0))).cast("long")
    return df.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_deleted")], n_lines.alias("n_lines"), n_deleted.alias("n_deleted"))


def remaining(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs without later copies of repeated runs and without documents of which only copies were found; n_chars, if there is one, is made to follow the text."""
    out = deduplicated(docs, min_words).filter("n_deleted = 0 or n_deleted < n_lines")
    length = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return out.select(*[F.when(F.col("n_deleted") > 0, length).otherwise(F.col("n_chars")).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])
