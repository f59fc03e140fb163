"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions.  Each decision node of a context, which is the last 0 to `depth` bytes, has a
Krichevsky-Trofimov estimate of its ones and zeros among the training texts.  A node's weighted probability is the mean of
its own estimate and the product of its extensions' weighted probabilities; at the deepest context it is the estimate
alone.  A decision is predicted by the estimates of all depths, weighted by how likely the tree is to stop at each.

Texts are lowered (A-Z), stand behind `depth` bytes 0xFF and end with one, which no UTF-8 text holds, so that text ends
are predicted like bytes and the probabilities of all texts add up to one.

The model is no object: its nodes are rows.  Each batch of texts writes its distinct runs of depth + 1 bytes and words; sums
over batches are the counts; nodes are computed in tasks that hold all extensions of some two-byte contexts, at most
256 ** (depth - 1) runs for each; only the nodes of depth 0 and 1, at most 65,536 rows, pass the driver.  The price of a
run returns to the batches that hold it, which add up their texts.  All texts are read, whole, and all counts grow with them.

The base score takes words [^\\x20\\x09-\\x0D]+ of the lowered text, known by 64-bit hashes, and one end.  Null and empty
texts have the end alone.  Rows with one id stay separate rows and are learnt once each; a null id is held out.  Very
long texts are worked on in slices.  An empty table gives no rows; without training texts all estimates are one half and the
base score is 0.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.batches import finish, long_key, make_batches, record, summed, written
from llm.frames import map_batches, saved
from llm.words import lower_white_table, raw, signed, split, word_hashes

#: Bytes of context.
DEPTH = 4
END = 0xFF
#: Positions of a text, or runs, worked on at once.
SLICE = 1 << 20
#: Runs whose nodes are computed at once; one two-byte context is not divided.
TOGETHER = 200_000

MADE = "kind int, batch long, key long, n long, ids array<long>, held array<boolean>, sizes array<long>, body binary"
ARROW = pa.schema(
    [("kind", pa.int32()), ("batch", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())),
     ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("body", pa.binary())]
)
TEXT, RUN, WORD = 0, 1, 2

NODES = "kind int, key long, node int, ones double, total double, weighted double, p array<double>"
NODES_ARROW = pa.schema(
    [("kind", pa.int32()), ("key", pa.int64()), ("node", pa.int32()), ("ones", pa.float64()), ("total", pa.float64()),
     ("weighted", pa.float64()), ("p", pa.list_(pa.float64()))]
)
DONE = (
    "doc_id long, held_out boolean, n_words long, words_known long, n_bytes long, words_score double, score double, "
    "train_docs long, train_words long, new_words long"
)
DONE_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_words", pa.int64()), ("words_known", pa.int64()),
     ("n_bytes", pa.int64()), ("words_score", pa.float64()), ("score", pa.float64()), ("train_docs", pa.int64()),
     ("train_words", pa.int64()), ("new_words", pa.int64())]
)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 7; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(True))


def lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function of positive numbers, by the asymptotic series eight steps further."""
    low = np.ones_like(x)
    for i in range(8):
        low = low * (x + i)
    z = x + 8
    s = 1 / (z * z)
    series = (1 / 12 - s * (1 / 360 - s * (1 / 1260 - s * (1 / 1680 - s / 1188)))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(low)


def estimate(ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return lgamma(ones + 0.5) + lgamma(total - ones + 0.5) - lgamma(total + 1.0) - np.log(np.pi)


def stop_weight(own: np.ndarray, further: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log of the weighted probability of nodes from their estimate and their extensions', and the weight of stopping."""
    both = np.logaddexp(own, further) - np.log(2)
    return both, np.exp(own - np.log(2) - both)


def runs(data: np.ndarray, offsets: np.ndarray, depth: int, low: int, high: int) -> np.ndarray:
    """For positions low to high of the padded texts: the bytes before it, latest first, and the byte itself, as a number.

    data holds texts one behind another, each behind `depth` END bytes and followed by those of the next."""
    key = data[low + depth : high + depth].astype(np.int64)
    for back in range(1, depth + 1):
        key |= data[low + depth - back : high + depth - back].astype(np.int64) << (8 * (depth + 1 - back))
    return key


def padded(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with depth END bytes before each and behind the last; and where each text's bytes begin, less depth."""
    n = len(offsets) - 1
    start = offsets[:-1] + depth * np.arange(n)
    out = np.full(len(data) + depth * (n + 1), END, np.uint8)
    size = np.diff(offsets)
    out[np.arange(len(data)) + np.repeat(start + depth - offsets[:-1], size)] = data
    return out, start


def positions(start: np.ndarray, size: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the places low to high are bytes or the end of a text, and whose."""
    at = np.arange(low, high)
    owner = np.searchsorted(start, at, side="right") - 1
    return at - start[owner] <= size[owner], owner


class _Batch:
    """Texts of a batch, its runs with their number in training texts, and its words likewise."""

    def __init__(self, number: int, depth: int):
        self.number, self.depth = number, depth
        self.texts, self.keys, self.found = [], {RUN: [], WORD: []}, {RUN: [], WORD: []}

    def _count(self, kind: int, key: np.ndarray, train: np.ndarray) -> None:
        key, n = summed([key], [train.astype(np.int64)])
        self.keys[kind].append(key)
        self.found[kind].append(n)

    def add(self, rows, texts) -> None:
        ids = rows.column(rows.schema.get_field_index("doc_id")).to_pylist()
        held = np.array(rows.column(rows.schema.get_field_index("held_out")).to_pylist(), bool)
        table, (data, offsets) = lower_white_table(), raw(texts)
        low = data + 32 * ((data >= 0x41) & (data <= 0x5A)).astype(np.uint8)
        size = np.diff(offsets)
        body, start = padded(low, offsets, self.depth)
        for at in range(0, len(body) - self.depth, SLICE):
            stop = min(at + SLICE, len(body) - self.depth)
            real, owner = positions(start, size, at, stop)
            key = runs(body, offsets, self.depth, at, stop)
            self._count(RUN, key[real], ~held[owner[real]])
        words = split(texts, table)
        self._count(WORD, signed(word_hashes(words)), ~held[words.owner])
        self.texts.append((ids, held.tolist(), size.tolist(), pa.compress(low.tobytes(), codec="zstd", asbytes=True)))

    def done(self):
        for ids, held, size, body in self.texts:
            yield record(ARROW, 1, kind=[TEXT], batch=[self.number], ids=[ids], held=[held], sizes=[size], body=[body])
        for kind in (RUN, WORD):
            key, n = summed(self.keys[kind], self.found[kind])
            if len(key):
                yield record(ARROW, len(key), kind=np.full(len(key), kind, np.int32), batch=np.full(len(key), self.number), key=key, n=n)


def deep_nodes(key: np.ndarray, n: np.ndarray, depth: int) -> tuple[np.ndarray, dict]:
    """For sorted runs of whole two-byte contexts: what the contexts of two bytes and more predict for each of the
    eight decisions, and the nodes of the two-byte contexts."""
    p = np.empty((len(key), 8))
    top = {"key": [], "node": [], "ones": [], "total": [], "weighted": []}
    symbol = key & 255
    for j in range(8):
        node, bit = (1 << j) | (symbol >> (8 - j)), (symbol >> (7 - j)) & 1
        below = None
        for d in range(depth, 1, -1):
            name, back = np.unique(((key >> (8 * (depth + 1 - d))) << 8) | node, return_inverse=True)
            total = np.bincount(back, weights=n, minlength=len(name))
            ones = np.bincount(back, weights=n * bit, minlength=len(name))
            own = estimate(ones, total)
            one = (ones[back] + 0.5) / (total[back] + 1)
            said = np.where(bit == 1, one, 1 - one)
            if below is None:
                weighted, p[:, j] = own, said
            else:
                parent = np.searchsorted(name, ((below[0] >> 16) << 8) | (below[0] & 255))
                weighted, stop = stop_weight(own, np.bincount(parent, weights=below[1], minlength=len(name)))
                p[:, j] = stop[back] * said + (1 - stop[back]) * p[:, j]
            below = name, weighted
        for c, v in zip(top, (name >> 8, name & 255, ones, total, weighted)):
            top[c].append(v)
    return p, {c: np.concatenate(v) for c, v in top.items()}


def _deep(batches, depth: int):
    """Rows of runs and of two-byte nodes, from runs sorted by number; a two-byte context lies in one task."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out(key, n):
        p, top = deep_nodes(key, n, depth)
        for at in range(0, len(key), 50_000):
            part = p[at : at + 50_000]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, 8 * len(part) + 1, 8, dtype=np.int32)), pa.array(part.ravel()))
            yield record(NODES_ARROW, len(part), kind=np.full(len(part), RUN, np.int32), key=key[at : at + 50_000], p=lists)
        rows = len(top["key"])
        yield record(NODES_ARROW, rows, kind=np.zeros(rows, np.int32), key=top["key"], node=top["node"].astype(np.int32),
                     ones=top["ones"], total=top["total"], weighted=top["weighted"])

    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.float64)))
        if sum(len(k) for k, _ in held) < TOGETHER:
            continue
        key, n = (np.concatenate(x) for x in zip(*held))
        context = key >> (8 * (depth - 1))
        cut = int(np.searchsorted(context, context[-1]))  # the last context may go on
        held = [(key[cut:], n[cut:])]
        if cut:
            yield from out(key[:cut], n[:cut])
    if held:
        key, n = (np.concatenate(x) for x in zip(*held))
        if len(key):
            yield from out(key, n)


def shallow(rows: list) -> np.ndarray:
    """For each latest byte and node: weight of deeper contexts, and what depths 0 and 1 add for a one and for a zero.

    rows: (byte, node, ones, total, log weighted probability of the extensions)."""
    ones, total, further = np.zeros((3, 256, 256))
    for byte, node, o, t, w in rows:
        ones[byte, node], total[byte, node], further[byte, node] = o, t, w
    weighted, stop1 = stop_weight(estimate(ones, total), further)
    ones0, total0 = ones.sum(0), total.sum(0)
    _, stop0 = stop_weight(estimate(ones0, total0), weighted.sum(0))
    one1, one0 = (ones + 0.5) / (total + 1), (ones0 + 0.5) / (total0 + 1)
    rest = (1 - stop0) * (1 - stop1)
    return np.stack([rest, stop0 * one0 + (1 - stop0) * stop1 * one1, stop0 * (1 - one0) + (1 - stop0) * stop1 * (1 - one1)])


def _priced(batches, top, depth: int):
    for batch in batches:
        key = batch.column(0).to_numpy()
        p = batch.column(1).flatten().to_numpy().reshape(-1, 8)
        latest, symbol, price = key >> (8 * depth), key & 255, np.zeros(len(key))
        for j in range(8):
            node, bit = (1 << j) | (symbol >> (8 - j)), (symbol >> (7 - j)) & 1
            rest, one, zero = top[:, latest, node]
            price += np.log10(np.where(bit == 1, one, zero) + rest * p[:, j])
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(price)], names=["key", "value"])


def _scored(texts: pa.Table, values: pa.Table, depth: int) -> pa.Table:
    kind, key, value = (values.column(c).to_numpy() for c in ("kind", "key", "value"))
    known = {}
    for k in (RUN, WORD):
        at = np.flatnonzero(kind == k)
        at = at[np.argsort(key[at])]
        known[k] = key[at], value[at]
    new = int((values.column("first").to_numpy(zero_copy_only=False) & (kind == WORD) & (value > 0)).sum())
    out, table = [], lower_white_table()
    for row in texts.select(["ids", "held", "sizes", "body"]).to_pylist():
        size, n, held = np.array(row["sizes"], np.int64), len(row["ids"]), np.array(row["held"], bool)
        offsets = np.concatenate([[0], np.cumsum(size)])
        plain = pa.decompress(row["body"], int(offsets[-1]), codec="zstd", asbytes=True)
        body, start = padded(np.frombuffer(plain, np.uint8), offsets, depth)
        score = np.zeros(n)
        for at in range(0, len(body) - depth, SLICE):
            stop = min(at + SLICE, len(body) - depth)
            real, owner = positions(start, size, at, stop)
            price = known[RUN][1][np.searchsorted(known[RUN][0], runs(body, offsets, depth, at, stop)[real])]
            score += np.bincount(owner[real], weights=price, minlength=n)
        array = pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(plain))
        words = split(array, table)
        h = signed(word_hashes(words))
        c = known[WORD][1][np.searchsorted(known[WORD][0], h)] if len(h) else np.zeros(0)
        n_words = np.bincount(words.owner, minlength=n)
        few = [
            np.bincount(words.owner, weights=c > 0, minlength=n).astype(np.int64), size,
            np.bincount(words.owner, weights=np.log10(c + 1), minlength=n), score, (~held).astype(np.int64),
            np.where(held, 0, n_words), np.r_[new, np.zeros(n - 1, np.int64)] if n else [],
        ]
        new = 0
        made = [row["ids"], row["held"], n_words, *few]
        out.append(pa.Table.from_arrays([pa.array(m, type=f.type) for m, f in zip(made, DONE_ARROW)], schema=DONE_ARROW))
    return pa.concat_tables(out) if out else DONE_ARROW.empty_table()


def report(docs: DataFrame, depth: int = DEPTH, learn_not: Column | None = None, limit: int | None = None) -> DataFrame:
    """One row per document: base score of its words, log10 probability of its bytes, and bits a byte.

    depth: bytes of context, 2 to 6. learn_not: which documents are held out."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    spark = docs.sparkSession
    held = held_out(F.col("doc_id")) if learn_not is None else learn_not
    given = docs.select(long_key(), "text", held.alias("held_out"))
    made = make_batches(given, lambda number: _Batch(number, depth), MADE, limit)

    counts = made.where(F.col("kind") == RUN).groupBy("key").agg(F.sum("n").alias("n"))
    context = F.shiftright("key", 8 * (depth - 1))
    ordered = counts.repartition(context).sortWithinPartitions("key")
    nodes = written(map_batches(ordered, lambda batches: _deep(batches, depth), NODES))
    upper = nodes.where("kind = 0").groupBy(F.shiftright("key", 8).alias("byte"), "node")
    upper = upper.agg(F.sum("ones"), F.sum("total"), F.sum("weighted")).collect()  # at most 256 x 255 rows
    top = spark.sparkContext.broadcast(shallow([tuple(r) for r in upper]))
    priced = map_batches(nodes.where(F.col("kind") == RUN).select("key", "p"), lambda b: _priced(b, top.value, depth), "key long, value double")

    runs_there = made.where(F.col("kind") == RUN).select("batch", "key").join(priced, "key")
    runs_there = runs_there.select("batch", F.lit(RUN).alias("kind"), "key", "value", F.lit(False).alias("first"))
    every = Window.partitionBy("key")  # a word's rows: one per batch that holds it
    words = made.where(F.col("kind") == WORD).select(
        "batch", F.lit(WORD).alias("kind"), "key", F.sum("n").over(every).cast("double").alias("value"),
        (F.col("batch") == F.min("batch").over(every)).alias("first"),
    )
    scored = saved(finish(made.where(F.col("kind") == TEXT), runs_there.unionByName(words), lambda t, v: _scored(t, v, depth), DONE))
    ends, n_words, distinct = scored.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("train_docs", "train_words", "new_words")]).first()
    train, kinds = n_words + ends, distinct + (ends > 0)
    end = float(np.log10(ends + 1))
    n_tokens = F.col("n_words") + 1
    return scored.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"),
        (F.col("words_known") + int(ends > 0)).alias("n_known"), F.lit(train).cast("long").alias("train_tokens"),
        (F.col("words_score") + F.lit(end) - n_tokens * F.lit(float(np.log10(train + kinds + 1)))).alias("base_score"),
        "score", "n_bytes",
        (F.col("score") / -np.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
