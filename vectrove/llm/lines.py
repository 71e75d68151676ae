"""Near-duplicate lines by MinHash, in DataFrame operations only.

A line's shingles are cut from its UTF-16 form, where any of them is found in constant time,
and hashed once; for each band that hash is hashed again with a seed of the band, to 64 bits,
of which three minima take 21 bits each. No two bands share a minimum, so two lines at a Jaccard
similarity of 0.75 meet with a probability of 99.3 %. (Lines of millions of characters meet
more often than they should, which costs comparisons and loses nothing.) Minima are grouped by
the line's hash, so copies of a line, however many, become one row before anything is shuffled. Lines that share a band of minima are compared exactly:
first with one line of each band, then, where a band still holds lines of different components
whose bitmaps let them link, pair by pair. One line of each component stays, the first by
doc_id and place.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrove.llm.common import discard, stored
from vectrove.llm.graph import stored_components

#: Characters of a shingle, bands of a signature, minima of a band and bits of each.
SHINGLE, BANDS, BAND, BITS = 8, 9, 3, 21
#: Shingles that a row holds on the way to the minima.
STEP = 3
#: 64-bit words of a line's bitmap.
WORDS = 32
#: Classes of line hashes, to see which texts a join may need.
CLASSES = 1 << 20


def constants(bands: int = BANDS) -> list[int]:
    draw = random.Random(7)
    return [draw.getrandbits(32) - (1 << 31) for _ in range(bands)]


def _plain(line: Column) -> Column:
    """The line as it is compared: lower case, ASCII white space at both ends away."""
    return F.lower(F.btrim(line, F.lit(" \t\r\x0b\x0c")))


def _units(plain: Column) -> Column:
    return F.encode(plain, "UTF-16BE")


def _shingle(units: Column, at: Column, size: int) -> Column:
    return F.substring(units, 2 * at + F.lit(1), F.lit(2 * size))


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc_id, t, at, h, plain``: the lines of all documents that hold more than white space.

    ``t`` is the text's hash, so rows that share an id but not the text are told apart.
    """
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n", -1)).alias("at", "line")
    )
    rows = rows.select("doc_id", "t", "at", _plain(F.col("line")).alias("plain")).where("plain <> ''")
    return rows.withColumn("h", F.xxhash64("plain"))


def line_bands(lines: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``h, bands``: the band hashes of each different line."""
    last = F.greatest(F.octet_length("u") / 2 - size, F.lit(0)).cast("int")
    units = lines.select("h", _units(F.col("plain")).alias("u")).select("h", "u", last.alias("last"))
    # A row for every ``STEP`` shingles, the last one repeated to fill it: minima stay the same.
    places = units.select("h", "u", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(STEP))).alias("i"))
    at = [F.least(F.col("i") + F.lit(s), F.col("last")) for s in range(STEP)]
    hashed = places.select("h", *(F.hash(_shingle(F.col("u"), i, size)).alias(f"x{s}") for s, i in enumerate(at)))
    # One hash of 64 bits makes the values of all minima of a band.
    wide = hashed.select("h", *(F.xxhash64(F.lit(c).cast("int"), f"x{s}").alias(f"b{b}_{s}") for b, c in enumerate(constants()) for s in range(STEP)))

    def value(b: int, j: int) -> Column:
        return F.least(*(F.shiftrightunsigned(f"b{b}_{s}", BITS * j).bitwiseAND((1 << BITS) - 1) for s in range(STEP)))

    minima = wide.groupBy("h").agg(*(F.min(value(b, j)).alias(f"m{b}_{j}") for b in range(BANDS) for j in range(BAND)))
    return minima.select("h", F.array(*(F.xxhash64(F.lit(b), *(f"m{b}_{j}" for j in range(BAND))) for b in range(BANDS))).alias("bands"))


def _set(plain: Column, size: int) -> Column:
    """The distinct shingle hashes of a line; its units are made once, as the variable of a one-element array."""

    def hashes(units: Column) -> Column:
        last = F.greatest(F.octet_length(units) / 2 - size, F.lit(0)).cast("int")
        return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(_shingle(units, i, size))))

    return F.transform(F.array(_units(plain)), hashes)[0]


def line_marks(texts: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``h, n, f0, f1, ...``: the number of different shingles of each line of ``texts(h, plain)``, and a bitmap of them.

    A bit says whether an odd number of shingles falls in its class. Where two lines differ in
    a bit, a shingle of that class is in one of them only, so they differ in no fewer shingles
    than their bitmaps in bits, however long they are.
    """
    hashed = texts.select("h", F.explode(_set(F.col("plain"), size)).alias("x"))
    word, bit = F.shiftright("x", 6).bitwiseAND(WORDS - 1), F.expr("shiftleft(1L, cast(x & 63 as int))")
    maps = [F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"f{i}") for i in range(WORDS)]
    return hashed.groupBy("h").agg(F.count("x").alias("n"), *maps)


def _apart(one: str, two: str) -> Column:
    """In how many bits their bitmaps differ; the columns start with these prefixes."""
    return sum((F.bit_count(F.col(f"{one}f{i}").bitwiseXOR(F.col(f"{two}f{i}"))) for i in range(WORDS)), F.lit(0))


def _may_link(one: str, two: str, percent: int) -> Column:
    """Whether their bitmaps let two lines link; the columns start with these prefixes."""
    return (100 - percent) * (F.col(f"{one}n") + F.col(f"{two}n")) >= (100 + percent) * _apart(one, two)


def _named(marks: DataFrame, prefix: str, key: str) -> DataFrame:
    return marks.select(F.col("h").alias(key), *(F.col(c).alias(f"{prefix}{c}") for c in marks.columns if c != "h"))


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of lines whose shingle sets have a Jaccard similarity of ``percent`` or more."""
    one = texts.select(F.col("h").alias("a"), F.col("plain").alias("x"))
    two = texts.select(F.col("h").alias("b"), F.col("plain").alias("y"))
    sets = pairs.join(one, "a").join(two, "b").select("a", "b", _set(F.col("x"), size).alias("x"), _set(F.col("y"), size).alias("y"))
    sets = sets.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("both"))
    return sets.where(100 * F.col("both") >= percent * (F.col("n") + F.col("m") - F.col("both"))).select("a", "b")


def shared_bands(lines: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``band, h, lo``: the bands that several different lines share, with the smallest of them."""
    signed = stored(line_bands(lines, size), "bands")
    spread = signed.select(F.explode("bands").alias("band"), "h")
    several = spread.groupBy("band").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").select("band", "lo")
    out = stored(spread.join(several, "band"), "shared")
    discard(signed)
    return out


def linked_lines(shared: DataFrame, texts: DataFrame, size: int = SHINGLE, percent: int = 75, rounds: int = 3) -> DataFrame | None:
    """``h, c``: lines that are linked with another one, and the smallest hash they reach; None if none is.

    ``shared`` as from :func:`shared_bands`, ``texts(h, plain)`` a row for each of its lines. In
    each of ``rounds`` rounds the lines of a band meet its first line, by another order each
    time, and each is verified with the one of them whose bitmap differs least. What is left meets pair by
    pair, where it is in different components and bitmaps don't rule the link out; such pairs
    alone become rows.
    """
    marks = stored(line_marks(texts, size), "marks")
    open_, comps = shared.select("band", "h"), None
    for turn in range(rounds + 1):
        labelled = open_.select("band", "h").withColumn("c", F.col("h"))
        if comps is not None:
            labelled = labelled.drop("c").join(comps, "h", "left").withColumn("c", F.coalesce("c", "h"))
        # Bands that hold more than one component; of bands with the same lines, one.
        members = F.count("h").alias("k"), F.sum(F.xxhash64("h").cast("decimal(20,0)")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "h")).alias("y")
        several = labelled.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), *members).where("lo < hi")
        several = several.groupBy("k", "x", "y").agg(F.min("band").alias("band")).select("band")
        old, open_ = open_, stored(labelled.join(several, "band"), "open")
        discard(shared if not turn else old)
        if turn < rounds:
            first = open_.groupBy("band").agg(F.min(F.struct(F.xxhash64("h", F.lit(turn)).alias("r"), "h", "c")).alias("o"))
            met = open_.join(first.select("band", F.col("o.h").alias("o"), F.col("o.c").alias("d")), "band").where("c <> d")
            met = met.select(F.col("h").alias("a"), F.col("o").alias("b")).distinct()
            met = met.join(_named(marks, "x", "a"), "a").join(_named(marks, "y", "b"), "b").where(_may_link("x", "y", percent))
            near = F.struct((_apart("x", "y") / (F.col("xn") + F.col("yn"))).alias("far"), "b")
            pairs = met.groupBy("a").agg(F.min(near).alias("o")).select("a", F.col("o.b").alias("b"))
        else:
            # A pair is a row once, in the first of the open bands that both are in.
            own = open_.groupBy("h").agg(F.sort_array(F.collect_set("band")).alias("own"))
            held = open_.join(own, "h").join(marks, "h")
            left = held.select("band", F.col("h").alias("a"), "c", F.col("own").alias("xown"), *(F.col(m).alias(f"x{m}") for m in marks.columns if m != "h"))
            right = held.select(F.col("band").alias("other"), F.col("h").alias("b"), F.col("c").alias("d"), F.col("own").alias("yown"), *(F.col(m).alias(f"y{m}") for m in marks.columns if m != "h"))
            on = (F.col("band") == F.col("other")) & (F.col("a") < F.col("b")) & (F.col("c") != F.col("d")) & _may_link("x", "y", percent)
            pairs = left.join(right, on & (F.array_intersect("xown", "yown")[0] == F.col("band"))).select("a", "b")
        good = stored(_verified(pairs, texts, size, percent), "good")
        if not good.isEmpty():
            # Links of earlier rounds are stars by now.
            links = good if comps is None else good.union(comps.select(F.col("h").alias("a"), F.col("c").alias("b")))
            old, comps = comps, stored_components(links, "h", "c")
            discard(old)
        discard(good)
    discard(open_, marks)
    return comps


def repeated_lines(docs: DataFrame, size: int = SHINGLE, percent: int = 75) -> DataFrame:
    """``doc_id, t, n_lines, removed``: for each document with lines, the places of those that go.

    Lines are linked when their sets of ``size``-character shingles (lower case, ASCII white
    space at both ends aside) have a Jaccard similarity of ``percent`` or more and their signatures
    meet; a line of fewer characters is one shingle. Of the lines that links connect, the
    first by doc_id, text hash and place stays. Lines of white space only are never removed
    and not counted. Rows without id or text are left out. Rows that repeat id and text count
    as one document.
    """
    lines = lines_of(docs.select("doc_id", "text"))
    shared = shared_bands(lines, size)
    # All places of all lines, and the line itself where it shares a band: one more scan. The
    # lines that share bands are the smaller side, so they are hashed and nothing is sorted.
    wanted = shared.select("h").distinct().withColumn("wanted", F.lit(True))
    # A table of at most ``CLASSES`` rows, so it may be broadcast: texts of other classes stay behind.
    of_class = F.pmod("h", F.lit(CLASSES))
    near = F.broadcast(wanted.select(of_class.alias("near")).distinct())
    close = lines.join(near, of_class == F.col("near"), "left").select("doc_id", "t", "at", "h", F.when(F.col("near").isNotNull(), F.col("plain")).alias("plain"))
    known = close.join(wanted.hint("shuffle_hash"), "h", "left")
    known = stored(known.select("doc_id", "t", "at", "h", F.when(F.col("wanted"), F.col("plain")).alias("plain")), "known")
    texts = known.where("plain is not null").groupBy("h").agg(F.min("plain").alias("plain"), F.max("plain").alias("other"))
    # Should two lines ever share a hash, they are not compared with others.
    texts = stored(texts.where("plain = other").select("h", "plain"), "texts")
    linked = linked_lines(shared, texts, size, percent)
    places = known.select("doc_id", "t", "at", "h").distinct()
    own = places.withColumn("c", F.col("h")) if linked is None else places.join(linked, "h", "left").withColumn("c", F.coalesce("c", "h"))
    own = stored(own.select("doc_id", "t", "at", "c"), "places")
    discard(known, texts, linked)
    first = own.groupBy("c").agg(F.min(F.struct("doc_id", "t", "at")).alias("first"), F.count("c").alias("n")).where("n > 1")
    marked = own.join(first.select("c", "first"), "c", "left")
    gone = F.col("first").isNotNull() & (F.struct("doc_id", "t", "at") != F.col("first"))
    return marked.groupBy("doc_id", "t").agg(
        F.count("at").alias("n_lines"), F.sort_array(F.collect_list(F.when(gone, F.col("at")))).alias("removed")
    )


def dedup_lines(docs: DataFrame, size: int = SHINGLE, percent: int = 75) -> DataFrame:
    """The table with repeated lines cut from ``text``; see :func:`repeated_lines`.

    All columns stay, and all rows, also those whose text becomes empty. A null id or text is
    left as it is; an empty text stays empty.
    """
    found = repeated_lines(docs, size, percent).where(F.size("removed") > 0).select("doc_id", "t", "removed")
    row = F.col("row")
    on = (row["doc_id"].cast("long") == F.col("doc_id")) & (F.xxhash64(row["text"]) == F.col("t"))
    joined = docs.select(F.struct(*docs.columns).alias("row")).join(found, on, "left")
    kept = F.filter(F.split(row["text"], "\n", -1), lambda _, i: ~F.array_contains(F.col("removed"), i))
    text = F.when(F.col("removed").isNull(), row["text"]).otherwise(F.array_join(kept, "\n"))
    return joined.select(*(text.alias("text") if c == "text" else row[c].alias(c) for c in docs.columns))
