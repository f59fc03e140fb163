"""Line dedup by a deletion-neighbourhood join: a line goes if an earlier line is at most one word edit away.

Words are [^\\x20\\x09-\\x0D]+ with A-Z lowered; lines are what stands between line feeds. Lines with fewer than `exact`
words are left alone, lines with fewer than `min_words` words go only if an earlier line has the same words. Earlier means
smaller (doc_id, line number); lines are judged on the input, not on what is left. One edit is one word put in, taken out
or replaced, between two lines of `min_words` words or more.

Every line with a word is judged for exact repeats, and for edits from NEAR_WORDS words on: one word of a shorter line is
half of it or more.

A line's variants are itself and itself without one word, as hashes. Two lines are at most one edit apart exactly if they
share a variant that is (a) both lines themselves, (b) one line itself and the other without a word, or (c) both without
the word at the same place. So the earliest line per variant and place answers for all the others: no pairs are made but
those of a line with the earliest one it meets; the edit distance is then verified on the words of both.

Variants are made only where they can meet: a line and its partner share their first or their last half, so a first pass
joins whole-line and half-line hashes, drops exact repeats, and passes on lines whose half another line holds. Each task
settles what its batch can settle and sends the earliest line per hash, so a line that a third of all documents hold
sends one row per batch. Texts are shuffled once, by document, and that exchange serves all later joins.

Very long texts and lines are read whole, by the task that holds them. A null or empty text is one empty line. A null id is larger than any other. Rows with one id rank as one document; lines
that tie in id and line number do not remove each other, so repeated rows fare alike. Extra columns pass through; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.frames import apart, map_batches, map_texts, saved
from llm.packed import column, known, member, packed
from llm.words import Piece, lower_white_table, mix, pieces, raw, split, word_hashes

NEAR_WORDS = 3
BATCH = 1 << 19  # rows that a task holds before it settles them and sends them on
LAST = (1 << 63) - 1
_POWER = 0xD6E8FEB86659FD93

HALVES = "key long, whole boolean, h long, doc long, line int, many boolean, gone binary, near binary"
VARIANTS = "key long, chk int, part int, doc long, line int, id long, pdoc long, pid long"
PAIRS = "doc long, id long, pdoc long, pid long"


@dataclass
class Lines:
    """owner: text of each line; number: from 0 in its text; first: where its words begin, one entry more than lines;
    start, end: its byte range in the piece, without the line feed."""

    piece: Piece
    owner: np.ndarray
    number: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def lines_of(texts: pa.Array) -> Lines:
    piece = split(texts, lower_white_table())
    data, offsets = raw(texts)
    feeds = np.flatnonzero(data == 10)
    begins = np.searchsorted(feeds, offsets)
    counts = np.diff(begins) + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    base = np.concatenate([[0], np.cumsum(counts)])
    number = np.arange(base[-1]) - np.repeat(base[:-1], counts)
    start = np.empty(base[-1], dtype=np.int64)
    start[number > 0] = feeds + 1
    start[base[:-1]] = offsets[:-1]
    end = np.empty(base[-1], dtype=np.int64)
    last = base[1:] - 1
    inner = np.ones(base[-1], bool)
    inner[last] = False
    end[inner] = feeds
    end[last] = offsets[1:]
    return Lines(piece, owner, number, np.searchsorted(piece.start, np.append(start, len(data))), start, end)


class _Sums:
    """Hashes of any run of words: sums of word hashes times powers, position-free after division by the first power."""

    def __init__(self, h: np.ndarray):
        with np.errstate(over="ignore"):
            self.up = np.full(len(h) + 1, _POWER, np.uint64)
            self.down = np.full(len(h) + 1, pow(_POWER, -1, 1 << 64), np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.cumprod(self.up, dtype=np.uint64), np.cumprod(self.down, dtype=np.uint64)
            self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.up[:-1], dtype=np.uint64)])

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.total[b] - self.total[a]) * self.down[a]

    def without(self, a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
        """The run from a to b without the word at p: what follows moves up by one."""
        with np.errstate(over="ignore"):
            return self.run(a, p) + self.run(p + 1, b) * self.up[p - a]


def _tag(h: np.ndarray, n: np.ndarray, kind: int) -> np.ndarray:
    """A key for a run's hash, its number of words and its role."""
    with np.errstate(over="ignore"):
        return mix(h + mix(n.astype(np.uint64) * np.uint64(8) + np.uint64(kind)))


def _identity(whole: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Tells a line within its document: by its words and its number."""
    return whole ^ (number.astype(np.uint64) << np.uint64(40))


def _judged(x: Lines, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.diff(x.first)
    pick = np.flatnonzero(n >= min_words)
    return pick, x.first[pick], x.first[pick + 1]


def _ids(rows) -> np.ndarray:
    return column(rows, "doc").to_numpy()


def _gather(batches, emit, settle):
    """What settle makes of the rows emitted, a batch at a time; a batch is let go before the next one is read."""
    held: list = []
    size = 0

    def settled():
        columns = [list(x) for x in zip(*held)]
        held.clear()
        for i, parts in enumerate(columns):
            columns[i] = np.concatenate(parts)
            parts.clear()
        return settle(columns)

    for batch in batches:
        for at, texts in pieces(column(batch, "text")):
            made = emit(batch.slice(at, len(texts)), texts)
            held.append(made)
            size += len(made[0])
            del made
            if size >= BATCH:
                size = 0
                yield settled()
    if held:
        yield settled()


def _halves(min_words: int, exact: int):
    """Whole-line and half-line hashes; a batch settles exact repeats and lines that meet within it.

    Lines with fewer than min_words words have no halves."""

    def emit(rows, texts):
        x = lines_of(texts)
        pick, a, b = _judged(x, exact)
        n = b - a
        s = _Sums(word_hashes(x.piece))
        h = _tag(s.run(a, b), n, 0)
        low, high = n // 2, (n - 1) // 2
        keys = [_tag(s.run(a, a + k), k, 1) for k in (low, high)] + [_tag(s.run(b - k, b), k, 2) for k in (n - low, n - 1 - high)]
        return [h, _ids(rows)[x.owner[pick]], x.number[pick].astype(np.int32), n >= min_words, *keys]

    def settle(columns):
        h, doc, line, halved, *keys = columns
        columns.clear()
        order = np.lexsort((line, doc, h))
        h, doc, line, halved, keys = h[order], doc[order], line[order], halved[order], [k[order] for k in keys]
        again = np.zeros(len(h), bool)  # an earlier line of this batch is the same
        again[1:] = h[1:] == h[:-1]
        lead = np.maximum.accumulate(np.where(~again, np.arange(len(h)), 0))
        tied = again & (doc == doc[lead]) & (line == line[lead])
        gone_doc, gone = packed(doc[again & ~tied], _identity(h, line)[again & ~tied])
        h, doc, line, halved, keys = h[~again], doc[~again], line[~again], halved[~again], [k[~again] for k in keys]
        k = np.concatenate([k[halved] for k in keys])
        at = np.tile(np.flatnonzero(halved), len(keys))
        del keys
        order = np.lexsort((at, k))
        k, at = k[order], at[order]
        del order
        twice = np.zeros(len(k), bool)
        twice[1:] = (k[1:] == k[:-1]) & (at[1:] == at[:-1])
        k, at = k[~twice], at[~twice]
        more = np.zeros(len(k), bool)
        more[1:] = k[1:] == k[:-1]
        many = np.zeros(len(k), bool)
        many[:-1] = more[1:]
        met = np.unique(at[more])
        near_doc, near = packed(doc[met], _identity(h, line)[met])
        one = at[~more]
        parts = len(gone_doc), len(near_doc)
        none = pa.nulls
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([h, k[~more], mix(gone_doc.view(np.uint64)), mix(near_doc.view(np.uint64))]).view(np.int64)),
                pa.array(np.concatenate([np.ones(len(h), bool), np.zeros(len(one) + sum(parts), bool)])),
                pa.array(np.concatenate([h, h[one], np.zeros(sum(parts), np.uint64)]).view(np.int64)),
                pa.array(np.concatenate([doc, doc[one], gone_doc, near_doc])),
                pa.array(np.concatenate([line, line[one], np.zeros(sum(parts), np.int32)])),
                pa.array(np.concatenate([np.zeros(len(h), bool), many[~more], np.ones(sum(parts), bool)])),
                pa.concat_arrays([none(len(h) + len(one), pa.binary()), pa.array(gone, pa.binary()), none(parts[1], pa.binary())]),
                pa.concat_arrays([none(len(h) + len(one) + parts[0], pa.binary()), pa.array(near, pa.binary())]),
            ],
            names=["key", "whole", "h", "doc", "line", "many", "gone", "near"],
        )

    return lambda batches: _gather(batches, emit, settle)


def _met(rows, owner: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which lines met another line's half and are not exact repeats; owner: the row of each."""
    bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
    hit = np.zeros(len(own), bool)
    for i, (near, gone) in enumerate(zip(known(rows, "near", "near_packs"), known(rows, "gone", "gone_packs"))):
        part = own[bounds[i] : bounds[i + 1]]
        hit[bounds[i] : bounds[i + 1]] = member(part, near) & ~member(part, gone)
    return hit


def _variants(min_words: int):
    """The deletion neighbourhoods of lines that met another line's half and are not exact repeats.

    A row that meets an earlier one in its batch already names it as its partner."""

    def emit(rows, texts):
        x = lines_of(texts)
        pick, a, b = _judged(x, min_words)
        words = word_hashes(x.piece)
        s, t = _Sums(words), _Sums(mix(words ^ np.uint64(0xA5A5A5A5)))
        own = _identity(_tag(s.run(a, b), b - a, 0), x.number[pick])
        hit = _met(rows, x.owner[pick], own)
        pick, a, b, own = pick[hit], a[hit], b[hit], own[hit]
        n = b - a
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        la, lb = np.repeat(a, n), np.repeat(b, n)
        left = np.repeat(n, n) - 1
        key = np.concatenate([_tag(s.run(a, b), n, 3), _tag(s.without(la, lb, la + nth), left, 3)])
        check = np.concatenate([t.run(a, b), t.without(la, lb, la + nth)]).astype(np.uint32).view(np.int32)
        part = np.concatenate([np.full(len(n), -1), nth]).astype(np.int32)
        line = np.concatenate([np.arange(len(n)), np.repeat(np.arange(len(n)), n)])
        doc = _ids(rows)[x.owner[pick]]
        return [key, check, part, doc[line], x.number[pick][line].astype(np.int32), own[line]]

    def settle(columns):
        key, check, part, doc, line, own = columns
        columns.clear()
        order = np.lexsort((line, doc, part, check, key))
        key, check, part = key[order], check[order], part[order]
        doc, line, own = doc[order], line[order], own[order]
        del order
        more = np.zeros(len(key), bool)
        more[1:] = (key[1:] == key[:-1]) & (check[1:] == check[:-1]) & (part[1:] == part[:-1])
        lead = np.maximum.accumulate(np.where(~more, np.arange(len(key)), 0))
        later = more & ((doc != doc[lead]) | (line != line[lead]))  # ties stay, so that each is judged
        own = own.view(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.where(later, mix(key ^ mix(doc.view(np.uint64))), key).view(np.int64)),  # dealt by document
                pa.array(check),
                pa.array(part),
                pa.array(doc),
                pa.array(line),
                pa.array(own),
                pa.array(doc[lead], mask=~later),
                pa.array(own[lead], mask=~later),
            ],
            names=["key", "chk", "part", "doc", "line", "id", "pdoc", "pid"],
        )

    return lambda batches: _gather(batches, emit, settle)


def _first_pass(texts: DataFrame, min_words: int, exact: int) -> DataFrame:
    """Per document: identities of exact repeats (gone) and of lines that met another line's half (near)."""
    rank, key = F.struct("doc", "line"), Window.partitionBy("key")
    plain = F.col("gone").isNull() & F.col("near").isNull()
    line = F.col("h").bitwiseXOR(F.shiftleft(F.col("line").cast("long"), 40))
    rows = (
        map_batches(texts.select("doc", "text"), _halves(min_words, exact), HALVES)
        .withColumn("least", F.min(rank).over(key))
        .withColumn("meets", F.max("many").over(key) | (F.min("h").over(key) != F.max("h").over(key)))
        .withColumn("later", plain & F.col("whole") & (rank > F.col("least")))
        .withColumn("close", plain & ~F.col("whole") & F.col("meets"))
        .where("later or close or gone is not null or near is not null")
    )
    return rows.groupBy("doc").agg(
        F.collect_list(F.when(F.col("later"), line)).alias("gone"),
        F.collect_list("gone").alias("gone_packs"),
        F.collect_set(F.when(F.col("close"), line)).alias("near"),
        F.collect_list("near").alias("near_packs"),
    )


def _partners(batches):
    """Variants, ordered by key, check and rank, to pairs: a whole line with the earliest one that shares its key, others
    with the earliest that lacks a word at their place, or else with the earliest whole one.

    Of the last key of a batch the earliest line per place is carried on, all that later rows can meet."""
    names = ["key", "chk", "part", "doc", "line", "id"]
    carried = None
    for batch in batches:
        made = column(batch, "pid").is_valid().to_numpy(zero_copy_only=False)
        rows = [column(batch, c).to_numpy()[~made] for c in names]
        settled = [column(batch, c).filter(pa.array(made)).to_numpy() for c in ("doc", "id", "pdoc", "pid")]
        old = 0 if carried is None else len(carried[0])
        rows = [np.concatenate(x) for x in zip(carried, rows)] if old else rows
        key, check, part, doc, line, own = rows
        at = np.arange(len(key))
        start = np.ones(len(key), bool)
        start[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
        group = np.cumsum(start) - 1
        first = np.maximum.accumulate(np.where(start, at, 0))
        order = np.lexsort((part, group))  # stable, so by rank within a place
        head = np.ones(len(key), bool)
        head[1:] = (group[order][1:] != group[order][:-1]) | (part[order][1:] != part[order][:-1])
        same = np.empty(len(key), np.int64)
        same[order] = order[np.maximum.accumulate(np.where(head, at, 0))]
        itself = np.full(start.sum(), len(key))
        lead = np.flatnonzero((part < 0) & (same == at))
        itself[group[lead]] = lead
        itself = np.minimum(itself[group], at)  # a later one is none
        later = lambda p: (doc[p] != doc) | (line[p] != line)
        partner = np.where(part < 0, first, np.where(later(same), same, itself))
        hit = np.flatnonzero(later(partner) & (at >= old))
        if len(key):
            carry = (group == group[-1]) & (same == at)
            carried = [x[carry] for x in rows]
        pairs = zip(settled, [doc[hit], own[hit], doc[partner[hit]], own[partner[hit]]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in pairs], names=["doc", "id", "pdoc", "pid"])


def _pairs(met: DataFrame, min_words: int) -> DataFrame:
    """Lines (doc, id) and the earlier lines (pdoc, pid) that share a variant with them, one or a few per line."""
    rows = map_batches(met, _variants(min_words), VARIANTS).repartition("key", "chk")
    return map_batches(rows.sortWithinPartitions("key", "chk", "doc", "line", "id"), _partners, PAIRS).distinct()


def one_edit(a: list[str], b: list[str]) -> bool:
    """At most one word put in, taken out or replaced."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def _met_lines(min_words: int):
    """(wdoc, wid, words) of the lines that variants are made of."""

    def run(batches):
        for batch in batches:
            for at, texts in pieces(column(batch, "text")):
                rows = batch.slice(at, len(texts))
                x = lines_of(texts)
                pick, a, b = _judged(x, min_words)
                own = _identity(_tag(_Sums(word_hashes(x.piece)).run(a, b), b - a, 0), x.number[pick])
                hit = _met(rows, x.owner[pick], own)
                words = [x.piece.span(i, j).decode() for i, j in zip(a[hit], b[hit])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_ids(rows)[x.owner[pick[hit]]]), pa.array(own[hit].view(np.int64)), pa.array(words, pa.string())],
                    names=["wdoc", "wid", "words"],
                )

    return run


def _second_pass(texts: DataFrame, first: DataFrame, min_words: int) -> DataFrame:
    """Per document: identities of lines one edit from an earlier line, each verified on the words of both.

    The words of every line with variants are sent, one row a line where variants are one a word. So pairs have one reader
    and need no job of their own, which would shuffle the texts once more. All joins of texts take all their columns: one
    exchange serves them. Pairs are exploded to their sides, which Spark sizes too low, so that join is told not to
    broadcast them; words are dealt for it anew, as only then a line that many pairs name can be split over tasks."""
    met = texts.join(first.where("size(near) > 0 or size(near_packs) > 0"), "doc")
    pair = F.struct("doc", "id", "pdoc", "pid").alias("pair")
    side = lambda n, doc, id_: F.struct(F.lit(n).alias("side"), F.col(doc).alias("wdoc"), F.col(id_).alias("wid"))
    sides = _pairs(met, min_words).select(pair, F.explode(F.array(side(0, "doc", "id"), side(1, "pdoc", "pid"))).alias("s"))
    words = map_batches(met, _met_lines(min_words), "wdoc long, wid long, words string")
    line = F.struct("wdoc", "wid").alias("line")
    words = words.groupBy(line).agg(F.min("words").alias("words")).select("line.*", "words")  # rows that share an id
    both = sides.select("pair", "s.*").hint("merge").join(words, ["wdoc", "wid"]).groupBy("pair").agg(
        F.min(F.when(F.col("side") == 0, F.col("words"))).alias("a"), F.min(F.when(F.col("side") == 1, F.col("words"))).alias("b")
    )

    def verify(batches):
        for batch in batches:
            ok = [one_edit(x.split(" "), y.split(" ")) for x, y in zip(column(batch, "a").to_pylist(), column(batch, "b").to_pylist())]
            yield batch.select(["doc", "id"]).filter(pa.array(ok, pa.bool_()))

    near = both.select("pair.doc", "pair.id", "a", "b").where("a is not null and b is not null")
    return map_batches(near, verify, "doc long, id long").groupBy("doc").agg(F.collect_set("id").alias("more"))


def _cut(docs: DataFrame, keep: list[str], min_words: int, exact: int | None) -> DataFrame:
    """Columns `keep` of docs, then doc, n_lines, n_removed, words_left and kept (null if nothing goes)."""
    texts = docs.withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    exact = min_words if exact is None else min(exact, min_words)
    first = saved(_first_pass(texts, min_words, exact))
    marked = (
        texts.join(first.select("doc", "gone", "gone_packs"), "doc", "left")
        .join(_second_pass(texts, first, min_words), "doc", "left")
    )

    def fn(rows, part):
        x = lines_of(part)
        data, offsets = raw(part)
        pick, a, b = _judged(x, exact)
        own = _identity(_tag(_Sums(word_hashes(x.piece)).run(a, b), b - a, 0), x.number[pick])
        bounds = np.searchsorted(x.owner[pick], np.arange(len(part) + 1))
        gone = np.zeros(len(x.owner), bool)
        for i, (old, new) in enumerate(zip(known(rows, "gone", "gone_packs"), known(rows, "more", None))):
            mine = own[bounds[i] : bounds[i + 1]]
            gone[pick[bounds[i] : bounds[i + 1]]] = member(mine, old) | member(mine, new)
        base = np.searchsorted(x.owner, np.arange(len(part) + 1))
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[base[1:]] - total[base[:-1]]
        words = np.concatenate([[0], np.cumsum(np.where(gone, 0, np.diff(x.first)))])
        kept: list[str | None] = []
        for i, n in enumerate(removed):
            rest = np.flatnonzero(~gone[base[i] : base[i + 1]]) + base[i] if n else ()
            kept.append(b"\n".join(data[x.start[j] : x.end[j]].tobytes() for j in rest).decode() if n else None)
        return [np.diff(base), removed, words[base[1:]] - words[base[:-1]], kept]

    fields = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_removed", "words_left")]
    fields.append(T.StructField("kept", T.StringType()))
    return map_texts(marked, fn, fields, keep, ("gone", "gone_packs", "more"))


def report(docs: DataFrame, min_words: int = NEAR_WORDS, exact: int | None = 1) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the lines left, joined by line feeds) for each row of docs.

    exact: words from which on exact repeats go; None: as many as min_words."""
    out = _cut(docs.select("doc_id", "text"), ["doc_id", "text"], min_words, exact)
    left = F.coalesce("kept", "text", F.lit("")).cast("binary")
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(left, 256).alias("kept_sha256"))


def clean(docs: DataFrame, min_words: int = NEAR_WORDS, exact: int | None = 1) -> DataFrame:
    """docs without repeated lines, columns unchanged; n_chars follows the text where that column exists.

    A row that loses lines and has no words left is dropped; other rows stay.
    """
    inner, names = apart(docs)
    out = _cut(inner, inner.columns, min_words, exact).where("n_removed = 0 or words_left > 0")
    new = {"text": F.coalesce("kept", "text")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col(names["n_chars"])).cast(kind)
    return out.select(*[new.get(c, F.col(names[c])).alias(c) for c in docs.columns])
