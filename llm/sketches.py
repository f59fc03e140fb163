"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, in built-in functions only.

A text is the set of its paragraphs (what stands between line feeds), each a 64-bit digest. A sketch has three tables of
cells; a digest is put into one cell of each, and a cell holds a count, the XOR of its digests and the XOR of their
checks. Subtracting two texts' sketches cancels what they share. Cells left with one digest are pure: their digest is taken
out of the other two tables, which makes further cells pure, until all cells are empty and every differing digest is
recovered. The tables take turns, so no digest is taken out twice. Where cells remain, the pair is tried again with new
hashes and cells for all its digests, then with more. Likeness is the shared share of the paragraphs of both texts.

A fingerprint is the cells of a text's smallest sketch (8 per table), 32 bits of each in hex, so equal texts have equal
ones. All aggregations of a try group by the pair's row, by which the digests were dealt once.

Neighbours come by range: rows in order of id and text hash are cut into as many ranges as there are shuffle partitions, and
the first document of a range is also sent to the range above it, so each range knows its last document's next one and no
task sees all rows. An id that many rows share spans several ranges; only rows that share both id and text share a task.

Likeness and the recovered digests come from the sketch size that could be peeled, which grows with the difference; the
fingerprint shown always has the smallest size.

Very long texts have as many paragraphs as they have, all in the sketch. A null text is empty and has one empty paragraph. A
null id comes last in descending order. Rows that share an id follow each other by their text's hash; equal rows are
interchangeable. A single document is its own next one. Texts of one code point or two stay as they are (nothing to
replace). Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.frames import saved

CELLS, TABLES = 8, 3
TURNS, TRIES = 18, 12
FIRST = -(1 << 63)


def _part(bounds: list[int]) -> Column:
    """The range of a row: how many bounds lie below its id; an id that m bounds share has m ranges, by the text's hash."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    long = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])

    def count(holds) -> Column:  # of sorted bounds, found by blocks, then within one
        block = F.size(F.filter(long(bounds[step - 1 :: step]), holds)) * step
        return block + F.size(F.filter(F.slice(long(bounds), block + 1, F.lit(step)), holds))

    below, upto = count(lambda b: b < F.col("id")), count(lambda b: b <= F.col("id"))
    share = F.floor((F.col("turn").cast("double") / 2.0**64 + 0.5) * (upto - below))
    return (below + F.when(upto - below > 1, F.least(share, upto - below - 1)).otherwise(0)).cast("int")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text: the text of the next row by descending id; after the last comes the first.

    Rows that share an id follow by their text's hash, and a range may begin among them, so an id that many rows share
    (null is one) is dealt over as many ranges as its share of the rows asks for."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], 20 * parts)).first()[0]
    bounds = sorted(found or []) if parts > 1 else []
    rows = rows.withColumn("turn", F.bitwise_not(F.xxhash64("text")))  # descending, like the id
    rows = rows.withColumn("part", _part(bounds))
    firsts = rows.groupBy("part").agg(F.max(F.struct("id", "turn")).alias("first")).select("part", "first.*")
    heads = sorted(tuple(r) for r in firsts.collect())  # one per range at most
    above = [(*heads[i - 1][1:], heads[i][0]) for i in range(len(heads))]  # the lowest range gets the very first document
    also = spark.createDataFrame(above or [(0, 0, 0)], "id long, turn long, above int")
    also = also.groupBy("id", "turn").agg(F.collect_list("above").alias("above"))
    both = rows.join(F.broadcast(also), ["id", "turn"], "left")
    places = F.concat(
        F.array(F.struct(F.col("part"), F.lit(0).alias("copy"))),
        F.coalesce(F.transform("above", lambda x: F.struct(x.alias("part"), F.lit(1).alias("copy"))), F.array().cast("array<struct<part:int,copy:int>>")),
    )
    dealt = both.select("id", "turn", "doc_id", "text", F.explode(places).alias("place")).select("id", "turn", "doc_id", "text", "place.*")
    order = Window.partitionBy("part").orderBy("copy", F.col("id").desc(), F.col("turn").desc())
    return dealt.withColumn("next_text", F.lead("text").over(order)).where("copy = 0").select("doc_id", "text", "next_text")


def digests(text: Column) -> Column:
    """The different paragraph digests of a text."""
    return F.array_distinct(F.transform(F.split(text, "\n", -1), lambda p: F.xxhash64(p)))


def _cell(digest: Column, size: Column, salt: Column, table: int) -> Column:
    return F.pmod(F.xxhash64(digest, salt, F.lit(table)), size).cast("long") + size * table


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def fingerprint(digests_: Column) -> Column:
    """The smallest sketch of a set of digests as text."""
    size, salt = F.lit(CELLS).cast("long"), F.lit(0).cast("long")
    placed = F.transform(digests_, lambda d: F.struct(d.alias("d"), F.array(*[_cell(d, size, salt, t) for t in range(TABLES)]).alias("at")))

    def cell(i: Column) -> Column:
        own = F.filter(placed, lambda p: F.array_contains(p["at"], i))
        return F.aggregate(own, F.lit(0).cast("long"), lambda acc, p: acc.bitwiseXOR(p["d"]))

    cells = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(CELLS * TABLES - 1).cast("long")), cell)
    fold = lambda c: F.shiftrightunsigned(c, 32).bitwiseXOR(c).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.lower(F.array_join(F.transform(cells, lambda c: F.lpad(F.hex(fold(c)), 8, "0")), ""))


def _cells(pairs: DataFrame) -> DataFrame:
    """The subtracted sketches' cells and, as cells below zero, what was recovered: a digest and its side, 1 or -1.

    pairs: row, pair, a, b, size, salt. A cell is pure at most once a turn, so (turn, cell) is a place of its own."""
    signed = F.concat(
        F.transform("a", lambda d: F.struct(d.alias("k"), F.lit(1).cast("long").alias("c"))),
        F.transform("b", lambda d: F.struct(d.alias("k"), F.lit(-1).cast("long").alias("c"))),
    )
    entry = lambda cell, c, k, x: F.struct(cell.alias("cell"), c.alias("c"), k.alias("k"), x.alias("x"))
    keys = pairs.select("row", "pair", "size", "salt", F.explode(signed).alias("s")).select("row", "pair", "size", "salt", "s.*")
    put = F.array(*[entry(_cell(F.col("k"), F.col("size"), F.col("salt"), t), F.col("c"), F.col("k"), _check(F.col("k"))) for t in range(TABLES)])
    cells = _summed(keys.select("row", "pair", "size", "salt", F.explode(put).alias("e")))
    for turn in range(TURNS):
        t = turn % TABLES
        pure = (F.floor(F.col("cell") / F.col("size")) == t) & (F.abs("c") == 1) & (F.col("x") == _check(F.col("k")))
        out = [entry(_cell(F.col("k"), F.col("size"), F.col("salt"), j), -F.col("c"), F.col("k"), F.col("x")) for j in range(TABLES) if j != t]
        place = -(F.col("size") * (TABLES * turn) + F.col("cell") + 1)
        gone = F.array(*out, entry(place, F.col("c"), F.col("k"), F.col("x")))
        same = F.array(entry(F.col("cell"), F.col("c"), F.col("k"), F.col("x")))
        cells = _summed(cells.select("row", "pair", "size", "salt", F.explode(F.when(pure, gone).otherwise(same)).alias("e")))
    return cells


def _summed(rows: DataFrame) -> DataFrame:
    out = rows.groupBy("row", "pair", "size", "salt", F.col("e.cell").alias("cell")).agg(
        F.sum("e.c").alias("c"), F.bit_xor("e.k").alias("k"), F.bit_xor("e.x").alias("x")
    )
    return out.where("cell < 0 or c <> 0 or k <> 0 or x <> 0")


def differences(pairs: DataFrame) -> DataFrame:
    """row, pair, differing, only_a, only_b: the digests that peeling recovers from the subtracted sketches of each pair of
    sets: how many, those of a alone and those of b alone, sorted. A pair of equal sets leaves no cell and is absent.

    pairs: row (long), pair (int), a and b (arrays of different longs, not null). Pairs that fail are tried again with
    cells for all their digests and growing reserve; each try takes the failed ones only.
    """
    parts = max(1, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    count = (F.size("a") + F.size("b")).cast("double")
    todo, done = pairs.select("row", "pair", "a", "b"), None
    for attempt in range(TRIES):
        size = F.lit(CELLS) if attempt == 0 else F.ceil(count * (0.5 + 0.25 * attempt)) + 4
        # a fixed number: rows are small before their cells are made, so adaptive partitions would be too few
        sized = todo.withColumn("size", size.cast("long")).withColumn("salt", F.lit(attempt).cast("long")).repartition(parts, "row")
        side = lambda sign: F.array_sort(F.collect_list(F.when((F.col("cell") < 0) & (F.col("c") == sign), F.col("k"))))
        found = _cells(sized).groupBy("row", "pair").agg(
            side(1).alias("only_a"), side(-1).alias("only_b"), F.count(F.when(F.col("cell") >= 0, 1)).alias("left_over")
        )
        found = saved(found)
        good = found.where("left_over = 0").select("row", "pair", (F.size("only_a") + F.size("only_b")).cast("long").alias("differing"), "only_a", "only_b")
        done = good if done is None else done.unionByName(good)
        failed = found.where("left_over > 0").select("row", "pair")
        if failed.isEmpty():
            return done
        todo = todo.join(failed, ["row", "pair"], "left_semi")
    raise RuntimeError(f"sketches of some pairs could not be peeled in {TRIES} tries")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, lost, gained for each row.

    The edited text has the last third of the code points replaced by as many of the next document's first. lost and
    gained are the digests of paragraphs that only the text and only the edited text have, as recovered by peeling."""
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    rows = with_next(docs).withColumn("n_chars", n.cast("long"))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)))
    rows = rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("changed"), digests(F.col("next_text")).alias("following"),
    )
    rows = saved(rows).withColumn("row", F.monotonically_increasing_id())
    pair = lambda i, other: F.struct(F.lit(i).alias("pair"), F.col("own").alias("a"), F.col(other).alias("b"))
    pairs = rows.select("row", F.explode(F.array(pair(0, "changed"), pair(1, "following"))).alias("p")).select("row", "p.*")
    of = lambda i, c: F.max(F.when(F.col("pair") == i, c))
    found = differences(pairs).groupBy("row").agg(
        of(0, F.col("differing")).alias("d0"), of(1, F.col("differing")).alias("d1"), of(0, F.col("only_a")).alias("lost"), of(0, F.col("only_b")).alias("gained")
    )

    def near(other: str, d: str) -> Column:
        total, d = F.size("own") + F.size(other), F.coalesce(F.col(d), F.lit(0))
        return (total - d) / (total + d)  # shared over all, as shared = (total - d) / 2 and all = (total + d) / 2

    none = F.array().cast("array<bigint>")
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, "row").join(found, "row", "left").select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        near("changed", "d0").alias("near_edited"), near("following", "d1").alias("near_next"),
        F.coalesce("lost", none).alias("lost"), F.coalesce("gained", none).alias("gained"),
    )
