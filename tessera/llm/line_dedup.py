"""Line dedup by MinHash over character shingles (operator 6, DataFrame functions only).

A line, in lower case and without white space at its ends, is the set of all its runs of 16
characters (UTF-16 units), with 15 line breaks before and behind it, so that its first and last
characters are in as many runs as all others.  Its signature is the minima of its hashes under 15
XOR masks, each a random order of them.  Six bands are three minima each: a pair at a similarity
of 0.8 shares a band, and nine minima, with probability 0.97, at 0.85 with 0.99.

1. Leaders.  Every line meets one line of each of its bands: the one whose bands are largest, as the
   middle of a group of near copies has the most lines near it.  Pairs of which nine minima agree
   are compared exactly, by their whole sets, and link at 0.8.  Their components, by union-find,
   settle what large groups of near copies are.
2. The rest.  Of bands that still hold lines of several components, those of at most ``GROUP`` lines
   are looked at whole: each line looks at all others of another component, and those of which nine
   minima agree are compared exactly, once.  Lines of larger ones have much in common, so they are
   met by what they differ in from their band's leader, and none at 0.8 is missed: a line that
   doesn't link to the leader shares a known part of these differences with whatever it links to,
   one of the first of both in the order of their frequency (``met_by_differences``).  Whatever
   meets so is compared exactly, once.
3. Union-find over all links; every line but a component's first, by document and place, goes.

Equal lines are one line from the start.  All sides of joins are sorted and spill; hot bands and
components are counted with partial sums, and their joins are ones that Spark splits.  A bitmap of
fixed size, broadcast, keeps lines and documents that nothing asks for out of the shuffles of texts.

Defined results: blank lines always stay; a null text has no lines and stays null; a row with a
null key is returned unjudged; rows that repeat a key and a text are one document, each of them
returned, rows that share a key only are documents of their own, in the order of a hash of their
texts; a line of any length is one line, compared row by row over ``LONG`` characters; other columns are kept as
they are; an empty table gives no rows.  Lines are told apart by two 64-bit hashes; where only the
first is equal, all of them stay.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common

SHINGLE = 16
#: A link: FIVES / 5 of the union.
FIVES = 4
#: Minima of a signature, those of each band, and how many must agree before whole sets are compared.
MINIMA = 15
BANDS = [(0, 1, 2), (3, 4, 5), (6, 7, 8), (9, 10, 11), (12, 13, 14), (0, 4, 8)]
AGREE = 9
#: Lines of a band in which all are looked at.
GROUP = 64
#: Shingles that are hashed from one piece of a line, and from one row.
PIECE, STEP = 256, 32
#: Characters of a line whose runs are compared as one array; longer ones are compared row by row.
LONG = 1 << 18
#: Bits of a broadcast bitmap: 2 MB at any size of the input.
BITS = 1 << 24
BLANK = " \t\n\x0b\x0c\r"
_rng = random.Random(611)
MASKS = [_rng.getrandbits(64) - 2**63 for _ in range(MINIMA)]


def line_key(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(BLANK)))


def once(df: DataFrame, value: Column, name: str, *keep: str) -> DataFrame:
    """The value as a generator's column: made once a row for all that is made of it."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, key) of every line that isn't blank."""
    got = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return once(got, line_key(F.col("line")), "key", "doc_id", "pos").where("key <> ''")


def line_id(key: str = "key") -> Column:
    return F.xxhash64(key)


def line_check(key: str = "key") -> Column:
    return F.xxhash64(F.lit(7), F.col(key))


def bitmap(values: DataFrame, c: str) -> DataFrame:
    """At most ``BITS / 32768`` rows of bits that are set for the values of a column, as arrays of 64-bit words."""
    at = F.pmod(F.col(c), F.lit(BITS))
    bits = values.groupBy(F.bitmap_bucket_number(at).alias("_ts_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_ts_bits"))
    # a word is looked up without a copy of all of them, as a slice of binary would make
    word = lambda b, k: F.conv(F.hex(F.substring(b, 8 * k + 1, F.lit(8))), 16, -10).cast("long")
    words = F.transform(F.array("_ts_bits"), lambda b: F.transform(F.sequence(F.lit(0), F.lit(511)), lambda k: word(b, k)))[0]
    return bits.select("_ts_bucket", words.alias("_ts_bits"))


def maybe_in(rows: DataFrame, c: str, bits: DataFrame) -> DataFrame:
    """Rows with ``_ts_in``: false only where the column's value isn't among those of the bitmap."""
    at = F.pmod(F.col(c), F.lit(BITS))
    got = rows.withColumn("_ts_bucket", F.bitmap_bucket_number(at)).withColumn("_ts_pos", F.bitmap_bit_position(at).cast("int")).join(F.broadcast(bits), "_ts_bucket", "left")
    # the first of a word's bytes is its highest
    hit = F.expr("getbit(_ts_bits[int(_ts_pos div 64)], 8 * (7 - int(_ts_pos div 8) % 8) + _ts_pos % 8)") == 1
    return got.withColumn("_ts_in", F.coalesce(hit, F.lit(False))).drop("_ts_bucket", "_ts_bits", "_ts_pos")


def units(key: str = "key") -> Column:
    """A text with two bytes for each character, so that every run of them is a slice."""
    ends = F.lit("\n" * (SHINGLE - 1))
    return F.encode(F.concat(ends, F.col(key), ends), "UTF-16BE")


def last_run(u: Column | str) -> Column:
    """Where the last run of a text begins, from 1."""
    return F.greatest(F.lit(1), F.length(u) - (2 * SHINGLE - 1))


def run_hash(u: Column | str, at: Column) -> Column:
    return F.xxhash64(F.substring(u, at, F.lit(2 * SHINGLE)))


def pieces(df: DataFrame, u: str, *keep: str) -> DataFrame:
    """Rows (keep, u) with texts cut to pieces that hold all their runs."""
    at = F.explode(F.sequence(F.lit(1), last_run(u), F.lit(2 * PIECE)))
    return df.select(*keep, u, at.alias("_ts_at")).select(*keep, F.substring(u, F.col("_ts_at"), F.lit(2 * (PIECE + SHINGLE - 1))).alias("u"))


def signatures(docs: DataFrame) -> DataFrame:
    """(id, sig) of every distinct line, the minima that bands are made of."""
    own = pieces(once(lines(docs).select(line_id().alias("id"), "key"), units(), "u", "id"), "u", "id")
    # several runs a row: the last ones of a piece are taken again, which changes no minimum
    own = own.select("id", "u", last_run("u").alias("last"), F.explode(F.sequence(F.lit(1), last_run("u"), F.lit(2 * STEP))).alias("at"))
    own = own.select("id", *[run_hash("u", F.least(F.col("at") + 2 * k, F.col("last"))).alias(f"h{k}") for k in range(STEP)])
    least = lambda mask: F.min(F.least(*[F.col(f"h{k}").bitwiseXOR(F.lit(mask)) for k in range(STEP)]))
    got = own.groupBy("id").agg(*[least(m).alias(f"s{k}") for k, m in enumerate(MASKS)])
    return got.select("id", F.array(*[F.hash(f"s{k}") for k in range(MINIMA)]).alias("sig"))


def band_keys(sig: str = "sig") -> Column:
    return F.array(*[F.xxhash64(F.lit(j), *[F.col(sig)[k] for k in band]) for j, band in enumerate(BANDS)])


def minima(name: str) -> list[Column]:
    """A signature's minima as columns that are never null.  Compared as elements of arrays, they make a
    generated method of over 8000 bytes, which the JVM only ever interprets."""
    return [F.coalesce(F.col("sig")[k], F.lit(0)).alias(f"{name}{k}") for k in range(MINIMA)]


def agreement(a: str, b: str) -> Column:
    return reduce(Column.__add__, [(F.col(f"{a}{k}") == F.col(f"{b}{k}")).cast("int") for k in range(MINIMA)])


def ordered(df: DataFrame) -> DataFrame:
    """Each pair (a, b) once, as a line asks for it: the leaders of many lines stand in b."""
    pair = df.where("a <> b").groupBy(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).agg(F.min("a").alias("a"))
    return pair.select("a", F.when(F.col("a") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("b"))


def banded(sigs: DataFrame) -> DataFrame:
    """(id, band, lead): the lines of every band of two or more, with the one that leads it."""
    one = sigs.select("id", F.explode(band_keys()).alias("band"))
    many = common.stored(one.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "line-band-sizes")
    met = common.stored(maybe_in(one, "band", bitmap(many, "band")).where("_ts_in").join(many, "band").select("id", "band", "n"), "line-bands")
    # the order of leaders: by the sizes of their bands, then by bits of their ids
    rank = F.shiftleft(F.least(F.sum("n"), F.lit(2**38)), 24).bitwiseOR(F.col("id").bitwiseAND(F.lit(2**24 - 1))).alias("rank")
    ranked = met.select("id", "band").join(met.groupBy("id").agg(rank), "id")
    lead = ranked.groupBy("band").agg(F.max_by("id", "rank").alias("lead"))
    return met.select("id", "band").join(lead, "band")


def left_over(bands: DataFrame, comp: DataFrame) -> DataFrame:
    """(id, band, lead, c, n): lines of bands that hold several components, n lines each."""
    own = bands.join(comp.withColumnRenamed("node", "id"), "id", "left").select("id", "band", "lead", F.coalesce("component", "id").alias("c"))
    per = own.groupBy("band").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    return common.stored(own.join(per.select("band", "n"), "band"), "line-bands-left")


def differences(pairs: DataFrame, text: DataFrame, some_long: bool) -> tuple[DataFrame, DataFrame | None]:
    """The runs that only one line of each pair (a, b, c) has.

    First (a, b, c, m, mb, more, less), one row a pair: m and mb are the sizes of the sets, ``more`` is what
    only a has, ``less`` what only b has.  Then, for pairs with a long line, (a, b, c, m, mb, d, h, mine), one
    row a run; d is the number of these.
    """
    both = beside(text, pairs.select("a", "b"))
    fits = F.greatest(F.length("k_a"), F.length("k_b")) <= LONG
    got = compared(both.where(fits) if some_long else both)
    size = lambda c: F.size(c).cast("long")
    got = got.select("a", "b", size(F.array_distinct("x")).alias("m"), size(F.array_distinct("y")).alias("mb"), F.array_except("x", "y").alias("more"), F.array_except("y", "x").alias("less"))
    got = common.stored(got.join(pairs, ["a", "b"]), "line-differences")
    if not some_long:
        return got, None
    per = common.stored(sided(both.where(~fits)), "line-long-runs")
    sizes = per.groupBy("a", "b").agg(F.count_if(F.col("low") == 1).alias("m"), F.count_if(F.col("high") == 2).alias("mb"), F.count_if(F.col("low") == F.col("high")).alias("d"))
    per = per.where("low = high").join(sizes.join(pairs, ["a", "b"]), ["a", "b"])
    return got, common.stored(per.select("a", "b", "c", "m", "mb", "d", "h", (F.col("low") == 1).alias("mine")), "line-long-differences")


def level(v: str) -> Column:
    """The power of four of a number: no less for a larger one."""
    return F.floor(F.log2(v) / 2)


def met_by_differences(large: DataFrame, text: DataFrame, some_long: bool) -> DataFrame:
    """(a, b): of lines (id, lead, c), all pairs of different components that link or may do so, without an estimate.

    Let m and d be the sizes of a line's set and of its difference from the leader, whose set has mb runs.
    Two sets are at 0.8 if they differ in at most a ninth of their sizes' sum, so

    * a line links to its leader if v = 9 d - m - mb isn't over 0: then it is in the leader's component;
    * two lines link only if their differences share t runs, 18 t >= (9 d - m) + (9 d' - m'): whatever both
      have changed alike is no difference of theirs.

    So a line that doesn't link to the leader meets another one of its band by what they changed alike, not by
    what all of them have.  The differences of a leader's lines are in one order: runs of one line only, then
    others by levels of how many lines have them, of a level first what only the leader has, the least frequent
    first.  What only the leader has are runs of one line, so their order is one array a leader, from which
    those of a line are cut; only what the leader hasn't meets its counts as rows.
    In that order,
    the first run that two share, at places p and p', has t - 1 behind it in both.  That bounds the places
    where x, with v > 0, may meet y: v <= w = 18 (1 + d' - p') - (9 d' - m') - mb, and 10 (1 + d - p) >= v as no
    line's size is further from mb than by d'.  Rows of y are dealt out by levels of v, so that those of
    which w is too small for a line aren't looked at.
    """
    pairs = large.where("id <> lead").select(F.col("id").alias("a"), F.col("lead").alias("b"), "c").distinct()
    own, long = differences(pairs, text, some_long)
    own = own.withColumn("d", (F.size("more") + F.size("less")).cast("long"))
    head = ["a", "b", "c", "m", "mb", "d"]
    each = own.select(*head) if long is None else own.select(*head).unionByName(long.select(*head).distinct())
    near = each.where("9 * d - m <= mb").join(large.where("id = lead").select(F.col("lead").alias("b"), F.col("c").alias("cb")).distinct(), "b").where("c <> cb").select("a", "b")
    often = lambda runs: runs.groupBy("b", "h").agg(F.count("*").alias("n")).where("n > 1").withColumn("level", F.floor(F.log2("n")))
    mine, theirs = own.select("b", F.explode("more").alias("h")), own.select("b", F.explode("less").alias("h"))
    if long is not None:
        mine, theirs = mine.unionByName(long.where("mine").select("b", "h")), theirs.unionByName(long.where("not mine").select("b", "h"))
    mine, theirs = often(mine), often(theirs)
    order = theirs if long is None else theirs.join(own.select("b").distinct(), "b", "left_semi")
    order = order.groupBy("b", "level").agg(F.sort_array(F.collect_list(F.struct("n", "h")))["h"].alias("hs")).groupBy("b").agg(F.collect_list(F.struct("level", "hs")).alias("order"))
    place = lambda level, mine, n, h: F.struct(level.alias("level"), mine.alias("mine"), n.cast("long").alias("n"), h.alias("h"))
    more = own.select("a", "b", F.explode("more").alias("h")).join(mine, ["b", "h"]).groupBy("a", "b").agg(F.collect_list(place(F.col("level"), F.lit(True), F.col("n"), F.col("h"))).alias("some"))
    less = F.flatten(F.transform("order", lambda o: F.transform(F.array_intersect(o["hs"], F.col("less")), lambda h, n: place(o["level"], F.lit(False), n, h))))
    none = F.array().cast("array<struct<level:bigint,mine:boolean,n:bigint,h:bigint>>")
    rows = own.join(order, "b", "left").select(*head, F.coalesce(less, none).alias("less")).join(more, ["a", "b"], "left")
    rows = once(rows, F.sort_array(F.concat("less", F.coalesce("some", none)))["h"], "hs", *head)
    # rest: how many runs that others have, this one too, are left from here on
    rows = rows.select(*head, F.size("hs").alias("k"), F.posexplode("hs").alias("at", "h")).select(*head, "h", (F.col("k") - F.col("at")).cast("long").alias("rest"))
    if long is not None:
        per = Window.partitionBy("b", "a")
        both = long.join(mine.unionByName(theirs), ["b", "h"])
        rest = 1 + F.count("*").over(per) - F.row_number().over(per.orderBy("level", "mine", "n", "h"))
        rows = rows.unionByName(both.select(*head, "h", rest.cast("long").alias("rest")))
    own = rows.withColumn("e", 9 * F.col("d") - F.col("m"))
    own = own.select("b", "h", "a", "c", "e", (F.col("e") - F.col("mb")).alias("v"), "rest", (18 * F.col("rest") - F.col("e") - F.col("mb")).alias("w"))
    own = common.stored(own.where("v > 0 and 10 * rest >= v or w > 0"), "line-changes")
    x = own.where("v > 0 and 10 * rest >= v").select("b", "h", level("v").alias("level"), F.col("a").alias("x"), F.col("v").alias("vx"), (18 * F.col("rest") - F.col("e")).alias("zx"), F.col("c").alias("cx"))
    y = own.where("w > 0").select("b", "h", F.explode(F.sequence(F.lit(0).cast("long"), level("w"))).alias("level"), F.col("a").alias("y"), "e", "w", F.col("v").alias("vy"), F.col("c").alias("cy"))
    met = x.join(y, ["b", "h", "level"]).where("cx <> cy and vx <= w and e <= zx and (vy <= 0 or x < y)")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).unionByName(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def within(members: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b): the pairs of groups (id, band, c) whose components differ and whose minima agree.

    A group has ``GROUP`` lines at most, and a row for each line and one of its group never leaves its stage.
    """
    per = members.groupBy("band").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    own = common.stored(members.join(per.select("band"), "band").join(sigs, "id").select("id", "band", "c", "sig"), "line-groups")
    groups = own.groupBy("band").agg(F.collect_list(F.struct("id", "c", *minima("s"))).alias("them"))
    seen = own.select("id", "band", "c", *minima("m")).join(groups, "band").select("id", "c", *[f"m{k}" for k in range(MINIMA)], F.explode("them").alias("x"))
    found = seen.where((F.col("id") < F.col("x.id")) & (F.col("x.c") != F.col("c")) & (agreement("x.s", "m") >= AGREE))
    return found.select(F.col("id").alias("a"), F.col("x.id").alias("b")).distinct()


def run_list(key: str) -> Column:
    """The hashes of all runs of a text, as an array.

    The text is a variable of the outer ``transform``: as a column of a row it would be copied for each run.
    """
    own = lambda u: F.transform(F.sequence(F.lit(1), last_run(u), F.lit(2)), lambda at: run_hash(u, at))
    return F.transform(F.array(units(key)), own)[0]


def compared(both: DataFrame) -> DataFrame:
    """(a, b, x, y): the hashes of all runs of both texts, as arrays."""
    # exploded, so that each array is made once
    return both.select("a", "b", F.explode(F.array(F.struct(run_list("k_a").alias("x"), run_list("k_b").alias("y")))).alias("s")).select("a", "b", "s.x", "s.y")


def sided(both: DataFrame) -> DataFrame:
    """(a, b, h, low, high): every run of both texts once, with the least and greatest side that has it, 1 or 2."""
    both = both.repartition(4 * common.partitions(both.sparkSession), "a", "b")
    sides = both.select("a", "b", F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("k_a").alias("k")), F.struct(F.lit(2).alias("side"), F.col("k_b").alias("k")))).alias("x"))
    runs = pieces(sides.select("a", "b", "x.side", units("x.k").alias("u")), "u", "a", "b", "side")
    runs = runs.select("a", "b", "side", "u", F.explode(F.sequence(F.lit(1), last_run("u"), F.lit(2))).alias("at")).select("a", "b", "side", run_hash("u", F.col("at")).alias("h"))
    return runs.groupBy("a", "b", "h").agg(F.min("side").alias("low"), F.max("side").alias("high"))


def counted(both: DataFrame) -> DataFrame:
    """(a, b) that link, for texts of any length: every run of both is a row, counted once."""
    per = sided(both).groupBy("a", "b").agg(F.count_if(F.col("low") < F.col("high")).alias("both"), F.count("*").alias("all"))
    return per.where(5 * F.col("both") >= FIVES * F.col("all")).select("a", "b")


def beside(text: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, k_a, k_b): pairs with their texts.

    ``b``, which may be one line for many, is met first, so that the comparisons are spread by ``a``.
    """
    side = lambda x: text.select(F.col("id").alias(x), F.col("key").alias(f"k_{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a")


def exact(text: DataFrame, pairs: DataFrame, some_long: bool) -> DataFrame:
    """The pairs (a, b) whose sets of all runs are similar enough."""
    both = beside(text, pairs)
    fits = F.greatest(F.length("k_a"), F.length("k_b")) <= LONG
    got = compared(both.where(fits) if some_long else both)
    union = F.size(F.array_union("x", "y"))
    # most pairs are told by the union alone: no set is larger than its array
    got = got.where(F.when((5 + FIVES) * union <= 5 * (F.size("x") + F.size("y")), 5 * F.size(F.array_intersect("x", "y")) >= FIVES * union)).select("a", "b")
    return common.stored(got.unionByName(counted(both.where(~fits))) if some_long else got, "line-links")


def line_table(docs: DataFrame, named: DataFrame) -> DataFrame:
    """(doc_id, pos, id, check, at, key) of every line, the key only where its id may be named."""
    # document and place as one number
    first = (F.col("doc_id").cast("decimal(19,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("pos")).cast("decimal(32,0)")
    own = maybe_in(lines(docs).select("doc_id", "pos", "key", line_id().alias("id")), "id", bitmap(named, "id"))
    return common.stored(own.select("doc_id", "pos", "id", line_check().alias("check"), first.alias("at"), F.when(F.col("_ts_in"), F.col("key")).alias("key")), "line-places")


def links(table: DataFrame, bands: DataFrame, named: DataFrame, sigs: DataFrame) -> DataFrame:
    """(a, b): links that join all that the bands show."""
    text = table.where(F.col("key").isNotNull()).select("id", "check", "key").groupBy("id").agg(F.min("key").alias("key"), F.min("check").alias("low"), F.max("check").alias("high"))
    text = common.stored(text.where("low = high").join(named, "id").select("id", "key"), "line-texts")
    some_long = not text.where(F.length("key") > LONG).isEmpty()
    sigs = common.stored(maybe_in(sigs, "id", bitmap(named, "id")).where("_ts_in").join(named, "id").select("id", "sig"), "line-signatures")
    side = lambda x: sigs.select(F.col("id").alias(x), *minima(f"s_{x}"))
    pairs = ordered(bands.select(F.col("id").alias("a"), F.col("lead").alias("b"))).join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.where(agreement("s_a", "s_b") >= AGREE).select("a", "b")
    tried = common.stored(pairs, "line-pairs")
    found = exact(text, tried, some_long)
    comp = common.stored(common.components(found), "line-components")
    # what the links so far join, as one link a line
    joined = comp.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    left = left_over(bands, comp)
    small, large = left.where(F.col("n") <= GROUP).select("id", "band", "c"), left.where(F.col("n") > GROUP).select("id", "lead", "c").distinct()
    found = within(small, sigs)
    if not large.isEmpty():
        found = found.unionByName(met_by_differences(common.stored(large, "line-large-bands"), text, some_long)).distinct()
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = common.stored(found.join(known, ["a", "b"], "left_anti"), "line-pairs")
    return joined.unionByName(exact(text, pairs, some_long))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, _ts_drop): the places of the lines that go."""
    sigs = common.stored(signatures(docs), "line-signatures")
    bands = common.stored(banded(sigs), "line-bands")
    named = common.stored(bands.select("id").distinct(), "line-names")
    occ = line_table(docs, named)
    comp = common.components(links(occ, bands, named, sigs)).withColumnRenamed("node", "id")
    per = occ.groupBy("id").agg(F.min("at").alias("at"), F.count("*").alias("n"), F.min("check").alias("low"), F.max("check").alias("high"))
    per = per.join(comp, "id", "left").where("low = high and (n > 1 or component is not null)").select("id", F.coalesce("component", "id").alias("component"), "at")
    per = common.stored(per, "line-components")
    head = per.groupBy("component").agg(F.min("at").alias("head"))
    of = common.stored(per.join(head, "component").select("id", "head"), "line-heads")
    gone = common.stored(occ.join(of, "id").where("at <> head").select("doc_id", "pos"), "line-repeats")
    return gone.groupBy("doc_id").agg(F.collect_set("pos").alias("_ts_drop"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines, with ``n_lines`` and ``n_removed``."""
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    kind = docs.schema["doc_id"].dataType
    docs, back = common.apart(docs.select(*names), "doc_id", "text")
    drop = common.stored(repeated_lines(docs.select("doc_id", "text")).withColumnRenamed("doc_id", "_ts_id"), "line-drops")
    # documents that the bitmap rules out don't take part in the shuffle of texts
    own = maybe_in(docs.withColumn("_ts_key", F.coalesce("doc_id", F.lit(0))), "_ts_key", bitmap(drop, "_ts_id")).drop("_ts_key")
    hit = own.where("_ts_in").join(drop, F.col("doc_id") == F.col("_ts_id"), "left")
    free = own.where("not _ts_in").select("*", F.lit(None).cast("long").alias("_ts_id"), F.lit(None).cast("array<int>").alias("_ts_drop"))
    got = hit.unionByName(free)
    split = F.split("text", "\n")
    kept = F.filter(split, lambda line, k: ~F.array_contains(F.col("_ts_drop"), k))
    text = F.when(F.col("_ts_drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    count = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(split)).cast("long")
    out = got.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in names], count.alias("n_lines"), F.coalesce(F.size("_ts_drop"), F.lit(0)).cast("long").alias("n_removed"))
    return back(out, "doc_id").withColumn("doc_id", F.col("doc_id").cast(kind))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
