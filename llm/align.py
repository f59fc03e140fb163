"""Alignment of two tokenizers over the same text.

Each token of one tokenizer points to the farthest-right token of the other that overlaps it; where both end at the same
byte, the pointer stops at the second tokenizer's token.  Doubling the pointers, all at once, brings each token to the last
token of its group: the bytes between two places where both tokenizers end a token.  Every overlapping pair of tokens is a
link, and an id pair counts the documents that hold it linked.

A task encodes each text once and writes, per batch of texts, the distinct id pairs and each document's own pairs as
positions in that list.  Counts per pair come from a sum over batches; they return to the batches by a join on the pair.

Null and empty texts, and texts that a tokenizer does not give back byte by byte (such as those with U+2581), have no
tokens: zeros and an empty groups_sha256.  Special tokens' strings are plain text.  Rows with one id, or a null id, stay
separate rows.  Very long texts are encoded whole, in one task, and hold about 100 bytes of memory a byte.  An empty table
gives no rows.  Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.batches import finish, long_key, make_batches, record, summed
from llm.frames import saved

#: Where the vocabulary files are; a parameter of every function that reads them.
FOLDER = "/opt/tokenizers"
#: The pattern that cuts texts for the byte-level vocabulary, and the bytes it writes as themselves.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

MADE = "kind int, batch long, key long, n long, ids array<long>, counts array<long>, groups array<string>, pairs binary"
ARROW = pa.schema(
    [("kind", pa.int32()), ("batch", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())),
     ("counts", pa.list_(pa.int64())), ("groups", pa.list_(pa.string())), ("pairs", pa.binary())]
)
PER_DOC = 5  # counts per document: n_a, n_b, n_groups, n_links, distinct pairs
OUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
OUT_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    + [("groups_sha256", pa.string())]
)


class Vocabulary:
    """Bytes and their number per id, and an encoder of several texts."""

    def __init__(self, parts: list[bytes]):
        self.parts = parts
        self.size = np.array([len(p) for p in parts], np.int64)

    def text(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.parts.__getitem__, ids.tolist()))


class ByteLevel(Vocabulary):
    """A byte-level vocabulary file whose ids are its merge ranks; each text is encoded behind a space."""

    def __init__(self, body: bytes):
        import tiktoken

        file = json.loads(body)
        letters = {chr(b): b for b in PLAIN}
        letters |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(PLAIN))}
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        words = {t: i for t, i in file["model"]["vocab"].items() if t not in special}
        ranks = {bytes(letters[c] for c in t): i for t, i in words.items()}
        parts = [b""] * (max([*words.values(), *special.values()]) + 1)
        for p, i in ranks.items():
            parts[i] = p
        super().__init__(parts)
        self.encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoding.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts]


class Pieces(Vocabulary):
    """A piece model with byte fallback, which sets a space before a text."""

    def __init__(self, body: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=body)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        byte = [self.model.is_byte(i) for i in range(len(names))]
        super().__init__([bytes([int(p[3:5], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(names, byte)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.model.encode(texts, num_threads=1)]


_LOADED: dict = {}


def vocabularies(bodies: tuple[bytes, bytes]) -> tuple[Vocabulary, Vocabulary]:
    """Both, made once per Python worker and pair of files."""
    key = tuple(hashlib.sha256(b).digest() for b in bodies)
    if key not in _LOADED:
        _LOADED[key] = ByteLevel(bodies[0]), Pieces(bodies[1])
    return _LOADED[key]


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """For each token of a, then of b, the number of the b token that ends its group. Both end at the same last byte."""
    n = len(end_a)
    far_a = np.searchsorted(end_b, end_a)  # the b token that holds a's last byte
    far_b = np.searchsorted(end_a, end_b)
    itself = np.arange(n, n + len(end_b))
    to = np.concatenate([far_a + n, np.where(end_a[far_b] > end_b, far_b, itself) if n else itself])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to - n
        to = further


def overlaps(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an a and a b token whose bytes overlap."""
    start_a = np.concatenate([[0], end_a[:-1]])
    low, high = np.searchsorted(end_b, start_a, side="right"), np.searchsorted(end_b, end_a)
    times = high - low + 1
    a = np.repeat(np.arange(len(end_a)), times)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times) + low[a]


class Spelled:
    """Decimal ids followed by each of the three separators."""

    def __init__(self, ids: int):
        self.ids, self.words = ids, [f"{i}{mark}" for mark in ",|;" for i in range(ids)]

    def groups(self, ids_a, ids_b, group_a, group_b) -> tuple[list[str], np.ndarray]:
        """The tokens in the order of the text `a1,a2|b1;...`, and the place there of each group's end."""
        last_a = np.r_[group_a[1:] != group_a[:-1], True]
        last_b = np.r_[group_b[1:] != group_b[:-1], True]
        place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)
        place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, side="right")
        out = np.empty(len(ids_a) + len(ids_b), np.int64)
        out[place_a] = ids_a + last_a * self.ids
        out[place_b] = ids_b + last_b * (2 * self.ids)
        return list(map(self.words.__getitem__, out.tolist())), place_b[last_b]


_SPELLED: dict[int, Spelled] = {}


def spelled(ids: int) -> Spelled:
    if ids not in _SPELLED:
        _SPELLED[ids] = Spelled(ids)
    return _SPELLED[ids]


def aligned(a: Vocabulary, b: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per text n_a, n_b, n_groups, n_links and the text of its groups; and all links as text, a id, b id."""
    counts, groups = np.zeros((len(texts), PER_DOC), np.int64), [""] * len(texts)
    some = [i for i, t in enumerate(texts) if t]
    given = [texts[i] for i in some]
    ids_a, ids_b, at = [], [], []
    for i, t, x, y in zip(some, given, a.encode(given), b.encode(given)):
        body = b" " + t.encode()
        if a.text(x) == body and b.text(y) == body:
            at.append(i)
            ids_a.append(x)
            ids_b.append(y)
    none = np.zeros(0, np.int64)
    if not at:
        return counts, groups, none, none, none
    at = np.array(at)
    n_a, n_b = (np.array([len(x) for x in ids]) for ids in (ids_a, ids_b))
    ids_a, ids_b = np.concatenate(ids_a), np.concatenate(ids_b)
    end_a, end_b = np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b])  # texts end where both tokenizers end
    last = terminals(end_a, end_b)
    number = np.cumsum(np.r_[0, np.diff(last[len(ids_a) :]) != 0])  # of the group of each b token
    group_a, group_b = number[last[: len(ids_a)]], number
    words, ends = spelled(max(len(a.parts), len(b.parts))).groups(ids_a, ids_b, group_a, group_b)
    first_b = np.cumsum(n_b) - n_b
    upto = np.concatenate([[0], ends + 1])
    first_group, last_group = group_b[first_b], group_b[np.cumsum(n_b) - 1]
    for i, low, high in zip(at, upto[first_group], upto[last_group + 1]):
        groups[i] = "".join(words[low:high])[:-1]
    link_a, link_b = overlaps(end_a, end_b)
    owner = np.repeat(np.arange(len(at)), n_a)[link_a]
    counts[at, 0], counts[at, 1], counts[at, 2] = n_a, n_b, last_group - first_group + 1
    counts[at, 3] = np.bincount(owner, minlength=len(at))
    return counts, groups, at[owner], ids_a[link_a], ids_b[link_b]


class _Batch:
    """Encodes pieces of texts; at the end writes documents with their pairs and the batch's list of pairs."""

    def __init__(self, number: int, bodies: tuple[bytes, bytes]):
        self.number, self.parts = number, []
        self.a, self.b = vocabularies(bodies)

    def add(self, rows, texts) -> None:
        counts, groups, doc, x, y = aligned(self.a, self.b, texts.to_pylist())
        key = np.sort((doc << 32) | (x * len(self.b.parts) + y))
        cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        times, key = np.diff(np.r_[cut, len(key)]), key[cut]
        counts[:, 4] = np.bincount(key >> 32, minlength=len(counts))
        shas = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        ids = rows.column(rows.schema.get_field_index("doc_id")).to_pylist()
        self.parts.append((ids, counts, shas, (key & 0xFFFFFFFF).astype(np.uint32), times.astype(np.uint32)))

    def done(self):
        keys, n = summed([p[3].astype(np.int64) for p in self.parts], [np.ones(len(p[3]), np.int64) for p in self.parts])
        for ids, counts, shas, key, times in self.parts:
            place = np.searchsorted(keys, key).astype(np.int64)
            step = np.diff(place, prepend=0)  # small, but for the first of each document
            planes = np.stack([step, times]).astype(np.int32).view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1)
            body = pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)
            yield record(ARROW, 1, kind=[0], batch=[self.number], n=[len(key)], ids=[ids], counts=[counts.ravel().tolist()],
                         groups=[shas], pairs=[body])
        if len(keys):
            yield record(ARROW, len(keys), kind=np.ones(len(keys), np.int32), batch=np.full(len(keys), self.number), key=keys, n=n)


def _reported(texts: pa.Table, values: pa.Table) -> pa.Table:
    """Documents of one batch with sums over their pairs."""
    order = np.argsort(values.column("key").to_numpy())
    n, best = values.column("n").to_numpy()[order], values.column("best").to_numpy()[order]
    out = []
    for row in texts.select(["n", "ids", "counts", "groups", "pairs"]).to_pylist():
        counts = np.array(row["counts"], np.int64).reshape(-1, PER_DOC)
        planes = np.frombuffer(pa.decompress(row["pairs"], 8 * row["n"], codec="zstd", asbytes=True), np.uint8)
        step, times = np.ascontiguousarray(planes.reshape(2, 4, -1).transpose(0, 2, 1)).view(np.int32)[:, :, 0].astype(np.int64)
        place = np.cumsum(step)
        owner = np.repeat(np.arange(len(counts)), counts[:, 4])
        top, total = np.zeros((2, len(counts)), np.int64)
        np.add.at(top, owner, times * (n[place] == best[place]))
        np.add.at(total, owner, times * n[place])
        made = [row["ids"], *counts.T[:4], top, total, row["groups"]]
        out.append(pa.Table.from_arrays([pa.array(m, type=f.type) for m, f in zip(made, OUT_ARROW)], schema=OUT_ARROW))
    return pa.concat_tables(out) if out else OUT_ARROW.empty_table()


def file_bodies(folder: str, first: str, second: str) -> tuple[bytes, bytes]:
    """Both vocabulary files: a few MB, read by the driver and sent with the tasks, so that workers need no such folder."""
    out = []
    for name in (first, second):
        with open(os.path.join(folder, name), "rb") as f:
            out.append(f.read())
    return tuple(out)


def report(
    docs: DataFrame, folder: str = FOLDER, first: str = "byte_bpe_50k.json", second: str = "piece_bpe_32k.model", limit: int | None = None
) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, and how its links stand in the whole corpus."""
    spark = docs.sparkSession
    files = spark.sparkContext.broadcast(file_bodies(folder, first, second))
    size = len(Pieces(files.value[1]).parts)
    if len(ByteLevel(files.value[0]).parts) * size > 1 << 32:
        raise ValueError("id pairs must fit in 32 bits")
    made = make_batches(docs.select(long_key(), "text"), lambda number: _Batch(number, files.value), MADE, limit)
    pairs = made.where("kind = 1").select("batch", "key", "n")
    counted = pairs.groupBy("key").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"key div {size}"))
    # an id of the first tokenizer has at most as many pairs as the second has ids
    scored = saved(counted.withColumn("best", F.max("n").over(Window.partitionBy("a"))).select("key", "n", "best"))
    values = pairs.select("batch", "key").join(scored, "key").select("batch", "key", "n", "best")
    return finish(made.where("kind = 0"), values, _reported, OUT)
