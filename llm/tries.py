"""The prefix trie of conversations, built as adaptive radix trees over runs of the sorted conversations.

A turn's id is 16 bytes, big-endian: the MD5 of its role and text.  A conversation's key is its ids in order, so keys sort by
their turns, and a node of the trie is a prefix of some key whose length is a multiple of 16.  Keys are range-partitioned by
(key, conv_id), so equal conversations spread over tasks too.  A task cuts its sorted keys into blocks of bounded size, builds
a radix tree of each and emits its turn-aligned nodes.  Only nodes on the path to a block's first or last key can also lie
in other blocks; these are summed, after taking off once what each two neighbouring blocks both counted: all figures are
sums over blocks then.  A single row per range (its first and last key) is ordered in one task.

conv_id null: the row belongs to no conversation.  Turns order by turn (null first), then by id; null role or text is empty.
Repeated rows are turns of their own.  A conversation's ids, 20 bytes a turn, meet in one task; texts never do.  An empty
table gives no nodes.  Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.batches import record, written
from llm.frames import map_batches
from llm.radix import Tree, common

WIDTH = 16
#: Bytes of keys in a block; one longer key is a block of its own.
BLOCK_BYTES = 8 << 20
#: Bytes of keys in a range of the sort.
RANGE_BYTES = 64 << 20
INNER, RIM, SHARED, ENDS = 0, 1, 2, 3

FIGURES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
MADE = (
    "kind int, block long, " + ", ".join(f"{c} long" for c in FIGURES) + ", node binary, above binary, ends_sha256 string, "
    "part int, first_key binary, first_sizes array<int>, last_key binary, last_sizes array<int>, ids binary"
)
ARROW = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), *[(c, pa.int64()) for c in FIGURES], ("node", pa.binary()), ("above", pa.binary()),
     ("ends_sha256", pa.string()), ("part", pa.int32()), ("first_key", pa.binary()), ("first_sizes", pa.list_(pa.int32())),
     ("last_key", pa.binary()), ("last_sizes", pa.list_(pa.int32())), ("ids", pa.binary())]
)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def name(prefix: bytes) -> bytes:
    """A node's name in joins."""
    return hashlib.sha256(prefix).digest()[:WIDTH]


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, ids and sizes (bytes of each text) of every rebuilt conversation's turns."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn_id = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % 5).alias("base"), conv.alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("o"), F.col("turn").alias("turn"), turn_id.alias("id"), F.octet_length(text).cast("int").alias("size")).alias("t"),
    )
    # both steps need the rows of a base together, so one exchange serves them
    whole = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    shared = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("t", 1, 8)), ignorenulls=True).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    whole = whole.withColumn("b", F.coalesce(shared, F.slice("t", 1, 0))).withColumn("h", h)
    head = F.when(F.col("h") > 0, F.expr("slice(b, 1, h)")).otherwise(F.slice("b", 1, 0))
    t = F.concat(head, F.expr("slice(t, h + 1, greatest(size(t) - h, 0))"))
    whole = whole.select("conv_id", t.alias("t"))
    return whole.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


class _Rows:
    """Aligned nodes of one block's tree, parents before children."""

    def __init__(self, keys: list[bytes], sizes: list, convs: list[int]):
        self.convs, self.sizes, self.keys = convs, sizes, keys
        tree = Tree()
        for i, k in enumerate(keys):
            tree.add(k, i)
        self.depth, self.parent, self.rep, self.ends = [0], [-1], [0], [tree.root.ends]
        todo = [(n, 0, 0) for n in reversed(tree.root.below())]
        while todo:
            node, at, above = todo.pop()
            stop, some = at + len(node.path), _some(node)
            for d in range(at // WIDTH + 1, stop // WIDTH + 1):
                self.depth.append(d)
                self.parent.append(above)
                self.rep.append(some)
                self.ends.append(node.ends if d * WIDTH == stop else [])
                above = len(self.depth) - 1
            todo.extend((n, stop, above) for n in reversed(node.below()))
        self._sum()

    def _sum(self) -> None:
        n = len(self.depth)
        self.n_convs, self.children, self.leaves, self.saved = ([0] * n for _ in range(4))
        self.low, self.high, self.least = [len(self.keys)] * n, [-1] * n, [None] * n
        for i in range(n - 1, -1, -1):
            if self.ends[i]:
                ids = [self.convs[e] for e in self.ends[i]]
                self.n_convs[i] += len(ids)
                self._least(i, min(self.ends[i]), max(self.ends[i]), min(ids))
            if not self.children[i]:
                self.leaves[i] = 1
            if self.depth[i]:
                self.saved[i] += (self.n_convs[i] - 1) * self.sizes[self.rep[i]][self.depth[i] - 1]
                up = self.parent[i]
                self.n_convs[up] += self.n_convs[i]
                self.children[up] += 1
                self.leaves[up] += self.leaves[i]
                self.saved[up] += self.saved[i]
                self._least(up, self.low[i], self.high[i], self.least[i])

    def _least(self, i: int, low: int, high: int, conv: int) -> None:
        self.low[i], self.high[i] = min(self.low[i], low), max(self.high[i], high)
        self.least[i] = conv if self.least[i] is None else min(self.least[i], conv)

    def prefix(self, i: int) -> bytes:
        return self.keys[self.rep[i]][: self.depth[i] * WIDTH]

    def rim(self, i: int) -> bool:
        """Whether the node leads to the block's first or last key, so that it may lie in other blocks too."""
        return self.low[i] == 0 or self.high[i] == len(self.keys) - 1


def _some(node) -> int:
    """The place of some key below."""
    while not node.ends:
        node = next(n for _, n in node.children.items())
    return node.ends[0]


def _listed(ids: list[int]) -> bytes:
    return ",".join(map(str, sorted(ids))).encode()


def _block(number: int, keys: list[bytes], sizes: list, convs: list[int]):
    """Rows of a block: its inner nodes, whole; those on its rim, in part, with the conversations that end there."""
    rows = _Rows(keys, sizes, convs)
    made = {f.name: [] for f in ARROW if f.name not in ("part", "first_key", "first_sizes", "last_key", "last_sizes")}
    rim = [rows.rim(i) for i in range(len(rows.depth))]
    names = {i: name(rows.prefix(i)) for i in range(len(rim)) if rim[i]}

    def put(**x):
        for c, v in made.items():
            v.append(x.get(c))

    for i in range(len(rim)):
        up, ids = rows.parent[i], [rows.convs[e] for e in rows.ends[i]]
        figures = {
            "block": number, "conv_id": rows.least[i], "depth": rows.depth[i], "n_convs": rows.n_convs[i],
            "n_children": rows.children[i], "n_leaves": rows.leaves[i], "saved_tokens": rows.saved[i],
        }
        above = names.get(up)
        if rim[i]:
            put(kind=RIM, node=names[i], above=above, **figures)
            if ids:
                put(kind=ENDS, block=number, node=names[i], ids=_listed(ids))
        else:
            put(kind=INNER, above=above, parent_conv_id=None if above else rows.least[up],
                ends_sha256=hashlib.sha256(_listed(ids)).hexdigest(), **figures)
    return record(ARROW, len(made["kind"]), **made)


def _shared(last: bytes, last_sizes, first: bytes):
    """Two neighbours' common nodes: what both counted, to be taken off."""
    depth = common(last, first) // WIDTH
    whole = depth * WIDTH == len(last)  # its end counted as a leaf, though it goes on in the next block
    made = {c: [] for c in ("kind", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "node", "above")}
    saved = 0
    for d in range(depth, -1, -1):
        saved += last_sizes[d - 1] if d else 0
        above = name(last[: (d - 1) * WIDTH]) if d else None
        for c, v in zip(made, (SHARED, d, 0, -int(d < depth), -int(whole), saved, name(last[: d * WIDTH]), above)):
            made[c].append(v)
    return record(ARROW, depth + 1, **made)


def _built(batches, limit: int):
    """Blocks of a range in order, corrections between them, and the range's first and last key."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    number, held = part << 24, 0
    keys, sizes, convs = [], [], []
    first = last = None

    def block():
        nonlocal number, held, keys, sizes, convs, last
        number += 1
        yield _block(number, keys, sizes, convs)
        if last is not None:
            yield _shared(*last, keys[0])
        last = keys[-1], sizes[-1]
        held, keys, sizes, convs = 0, [], [], []

    for batch in batches:
        for key, size, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if keys and held + len(key) + 64 > limit:
                yield from block()
            if first is None:
                first = key, size
            keys.append(key)
            sizes.append(size)
            convs.append(conv)
            held += len(key) + 64
    if keys:
        yield from block()
    if first is not None:
        yield record(ARROW, 1, kind=[-1], part=[part], first_key=[first[0]], first_sizes=[first[1]], last_key=[last[0]], last_sizes=[last[1]])


def _between(batches):
    for batch in batches:
        for row in batch.to_pylist():
            yield _shared(row["last_key"], row["last_sizes"], row["next_key"])


def _hashed(batches):
    """SHA-256 of each node's lists, which come one behind another; no list is held whole."""
    now, state = None, None
    for batch in batches:
        nodes, shas = [], []
        for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if node != now:
                if now is not None:
                    nodes.append(now)
                    shas.append(state.hexdigest())
                now, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(shas, pa.string())], names=["node", "sha"])
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["node", "sha"])


def _keyed(batches):
    """ids joined into the key."""
    for batch in batches:
        keys = [b"".join(x) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column(2), batch.column(0)], names=["key", "sizes", "conv_id"])


def report(conversations: DataFrame, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations."""
    keyed = written(map_batches(rebuilt(conversations), _keyed, "key binary, sizes array<int>, conv_id long"))
    size = keyed.agg(F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0))).first()[0]
    ranges = max(1, -(-size // range_bytes))
    ordered = keyed.repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = written(map_batches(ordered, lambda batches: _built(batches, block_bytes), MADE))

    # one row per range
    rims = made.where("kind = -1").select("part", "first_key", "last_key", "last_sizes")
    pairs = rims.withColumn("next_key", F.lead("first_key").over(Window.orderBy("part"))).where("next_key IS NOT NULL")
    between = map_batches(pairs.select("last_key", "last_sizes", "next_key"), _between, MADE)
    columns = ["node", "above", *FIGURES]
    parts = made.where(F.col("kind").isin(RIM, SHARED)).select(columns).unionByName(between.select(columns))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    rim = parts.groupBy("node").agg(F.max("above").alias("above"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums)
    lists = made.where(F.col("kind") == ENDS).select("node", "block", "ids").repartition("node").sortWithinPartitions("node", "block")
    shas = map_batches(lists, _hashed, "node binary, sha string")
    rim = written(rim.join(shas, "node", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(NO_ENDS))).drop("sha"))

    ids = rim.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    upper = rim.join(ids, "above", "left").select(out)
    inner = made.where(F.col("kind") == INNER)
    # a block's own rim nodes: at most as many as its first and last key have turns; the children of a node that all
    # blocks share are looked up block by block
    seen = made.where(F.col("kind") == RIM).select("block", F.col("node").alias("above"))
    looked = inner.where("above IS NOT NULL").drop("parent_conv_id").join(seen.join(ids, "above"), ["block", "above"]).select(out)
    return upper.unionByName(looked).unionByName(inner.where("above IS NULL").select(out))
