"""Secret scan with multipart credential linking, in built-in functions only.

Three base kinds of secrets are found by pattern. Weak parts (short or less telling identifiers, secrets and endpoints)
are found too, and reported only if a complementary part stands within SCOPE code points of the same text: an identifier
or endpoint needs a secret, a secret needs an identifier or endpoint; base spans count as parts. The interval join is a
sweep in order of the starts: the largest end so far and the smallest start to come, per role, tell whether any part of
that role reaches into the scope, so no pairs are made.

A pattern's matches and the gaps between them (the text split by the pattern) give the positions, in code points. Texts
that hold no trigger are not searched further; a trigger matches wherever its pattern does. Only small rows (lengths, not texts) are shuffled, by row.

Texts are searched whole, whatever their length. A null or empty text has no spans. Repeated rows are judged alike, each on its own; a null id is kept. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 300


def any_case(words: str) -> str:
    """A pattern that matches the given pattern's ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() and c.isascii() else c for c in words)


_GLUE = r"""["']?\x20*[:=]\x20*["']?"""
_ASSIGN = any_case("(password|passwd|secret|token|api_?key)") + _GLUE + "([A-Za-z0-9+/_.=-]+)"
_PLAIN = r"([^\x00-\x20\x22\x27,;<>]+)"


@dataclass(frozen=True)
class Kind:
    """name: what is reported; role: identifier, secret or endpoint; group: the part whose length counts; least: from
    that length on a match is reported alone, as the base kind `strong`; below it (and from `weak` on) it is a weak part."""

    name: str
    role: str
    pattern: str
    trigger: str
    group: int = 0
    weak: int = 1
    strong: str | None = None
    least: int = 0


# base kinds first, in the order in which they are listed
KINDS = (
    Kind("weak_assign", "secret", _ASSIGN, any_case("(password|passwd|secret|token|api_?key)"), 2, 3, "assign", 6),
    Kind("weak_access", "identifier", "AKIA[A-Z0-9]+", "AKIA", 0, 12, "access", 20),
    Kind("weak_hex", "secret", "[0-9a-f]{16,}", "[0-9a-f]{16}", 0, 16, "hex", 24),
    Kind("weak_key_id", "identifier", "A(SIA|IDA|ROA|GPA)[A-Z0-9]+", "A(SIA|IDA|ROA|GPA)[A-Z0-9]", 0, 16),
    Kind("weak_user", "identifier", any_case("(username|user|login|client_?id|key_?id)") + _GLUE + _PLAIN, any_case("(username|user|login|client_?id|key_?id)") + r"""["']?\x20*[:=]""", 2, 3),
    Kind("weak_pass", "secret", any_case("(pwd|passphrase|credentials?|private_?key)") + _GLUE + _PLAIN, any_case("(pwd|passphrase|credential|private_?key)"), 2, 6),
    Kind("weak_endpoint", "endpoint", r"[a-z][a-z0-9+]{1,9}://[^\x00-\x20\x22\x27<>]+", "://", 0, 8),
    Kind("weak_host", "endpoint", any_case("(host|hostname|endpoint|server)") + _GLUE + r"([A-Za-z0-9-]+[.][A-Za-z0-9.-]+)", any_case("(host|hostname|endpoint|server)"), 2, 4),
)
BASE = tuple(k.strong for k in KINDS if k.strong)
ORDER = (*BASE, *(k.name for k in KINDS))


def _matches(text: Column, kind: Kind) -> Column:
    """An array of (kind, place, gap before, length, length that counts) for each match in a text."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
    gaps = F.split(text, kind.pattern, -1)
    zipped = F.arrays_zip(found.alias("m"), counted.alias("c"), gaps.alias("g"))
    number = F.lit(KINDS.index(kind))
    made = F.transform(
        zipped,
        lambda x, i: F.struct(
            number.alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"), F.length(x["c"]).alias("counts")
        ),
    )
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,size:int,counts:int>>")
    return F.when(text.rlike(kind.trigger), F.filter(made, lambda x: x["size"].isNotNull())).otherwise(none)


def spans(docs: DataFrame) -> DataFrame:
    """row, doc_id, name, start, end: one line per span reported; lines without a name keep the rows of docs without spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    any_trigger = F.col("text").rlike("|".join(k.trigger for k in KINDS))
    held = F.concat(*[_matches(F.col("text"), k) for k in KINDS])
    parts = rows.select("row", "doc_id", F.when(any_trigger, held).alias("held"))
    parts = parts.select("row", "doc_id", F.explode_outer("held").alias("x")).select("row", "doc_id", "x.*").repartition("row")
    until = Window.partitionBy("row", "kind").orderBy("i")
    parts = parts.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(until).cast("long"))
    parts = parts.withColumn("start", F.col("end") - F.col("size"))

    def by_kind(value) -> Column:
        at = F.element_at(F.array(*[F.lit(value(k)) for k in KINDS]), F.col("kind") + 1)
        return F.when(F.col("kind").isNotNull(), at)  # element_at may give the last value for a null place

    strong = F.col("counts") >= by_kind(lambda k: k.least if k.strong else 1 << 30)
    parts = parts.withColumn("strong", F.coalesce(strong, F.lit(False))).withColumn("role", by_kind(lambda k: k.role))
    # a match that is too short has its place in the sums above, is no part, and still keeps its row
    part = F.col("strong") | (F.col("counts") >= by_kind(lambda k: k.weak))
    parts = parts.withColumn("part", F.coalesce(part, F.lit(False)))
    parts = parts.withColumns({c: F.when(F.col("part"), F.col(c)) for c in ("kind", "role")})
    before = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("row").orderBy("start").rangeBetween(0, Window.unboundedFollowing)

    def near(secret: bool) -> Column:
        """Some part that is (not) a secret reaches into the scope of this one."""
        match = (F.col("role") == "secret") == F.lit(secret)
        left = F.max(F.when(match, F.col("end"))).over(before) >= F.col("start") - SCOPE
        right = F.min(F.when(match, F.col("start"))).over(after) <= F.col("end") + SCOPE
        return F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))

    linked = F.when(F.col("role") == "secret", near(False)).otherwise(near(True))
    parts = parts.withColumn("linked", linked)
    name = F.when(F.col("strong"), by_kind(lambda k: k.strong)).when(F.col("linked"), by_kind(lambda k: k.name))
    return parts.withColumn("name", name).select("row", "doc_id", "name", "start", "end")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of docs."""
    place = F.array_position(F.array(*map(F.lit, ORDER)), F.col("name")).cast("int")
    text = F.concat_ws(":", "name", F.col("start").cast("string"), F.col("end").cast("string"))
    span = F.struct(F.col("start").alias("s"), place.alias("p"), text.alias("t"))

    def joined(wanted: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(wanted, span))), lambda x: x["t"]), ",")

    base = F.col("name").isin(*BASE)
    counts = [F.count(F.when(F.col("name") == k, 1)).alias(f"n_{k}") for k in BASE]
    return (
        spans(docs)
        .groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("name").isNotNull()).alias("spans"))
        .drop("row")
    )
