"""Language-model scores, the conversation trie and token alignment against brute force, and on odd rows."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import align, radix, treeweight, tries
from llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WHITE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
DOCS = [
    (1, "The cat sat. The cat ran; the dog sat"), (2, "the cat sat. The cat ran"), (2, "the cat sat. The cat ran"), (3, None),
    (4, ""), (5, " \t\n "), (None, "a null id is held out"), (None, None), (6, "日本語 é \U0001f600 U+2581 ▁ x"),
    (7, "<|endoftext|> <s> <0x41> \x00 don't"), (8, "x" * 20000 + " 12345 " * 900), (9, "\n\n\n  \n"), (11, "Zwölf Boxkämpfer"),
    (14, "the dog ran"), (15, "the dog sat"), (16, "cat"), (17, "the cat sat. The cat ran"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    extra = "key batch kind n ids held_out value node p counts groups pairs base score first".split()
    return df.withColumns({c: F.lit("extra") for c in extra}).repartition(3)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# --- language model


def tree_scores(texts, train, depth):
    """log10 probabilities by the recursive definition, from counts in dictionaries."""
    counts = defaultdict(lambda: [0, 0])

    def decisions(text):
        body = b"\xff" * depth + text.translate(LOWER).encode() + b"\xff"
        for at in range(depth, len(body)):
            for j in range(8):
                yield body[at - depth : at], (1 << j) | body[at] >> (8 - j), body[at] >> (7 - j) & 1

    seen = defaultdict(set)  # extensions of each context and node that occur in training
    for t in train:
        for context, node, bit in decisions(t):
            for d in range(depth + 1):
                counts[context[depth - d :], node][bit] += 1
                if d < depth:
                    seen[context[depth - d :], node].add(context[depth - d - 1 :])

    def own(s, node):
        a, b = counts.get((s, node), (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.cache
    def weighted(s, node):
        if len(s) == depth:
            return own(s, node)
        further = sum(weighted(x, node) for x in seen.get((s, node), ()))
        return math.log(0.5) + np.logaddexp(own(s, node), further)

    def predict(context, node, bit, d=0):
        s = context[depth - d :]
        c = counts.get((s, node), (0, 0))
        said = (c[bit] + 0.5) / (sum(c) + 1)
        if d == depth:
            return said
        stop = math.exp(math.log(0.5) + own(s, node) - weighted(s, node))
        return stop * said + (1 - stop) * predict(context, node, bit, d + 1)

    return [sum(math.log10(predict(*x)) for x in decisions(t)) for t in texts]


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


@pytest.mark.parametrize("depth,limit", [(2, 1), (4, 200), (3, None)])
def test_language_model_against_brute_force(docs, depth, limit):
    rows = [(i, t or "") for i, t in DOCS if not t or len(t) < 1000]
    few = docs.where("text IS NULL OR length(text) < 1000")
    got = treeweight.report(few, depth, limit=limit).collect()
    train = [t for i, t in rows if not held(i)]
    words = Counter(w for t in train for w in [*WHITE.findall(t.translate(LOWER)), None])
    n, v = sum(words.values()), len(words)
    want = []
    for (i, t), score in zip(rows, tree_scores([t for _, t in rows], train, depth)):
        tokens = [*WHITE.findall(t.translate(LOWER)), None]
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((i if i is not None else -1, held(i), len(tokens), sum(words[w] > 0 for w in tokens), n, base, score))
    want, got = sorted(want), sorted((r[0] if r[0] is not None else -1, *r[1:7]) for r in got)
    assert [w[:5] for w in want] == [g[:5] for g in got]
    assert np.allclose([w[5:] for w in want], [g[5:] for g in got], rtol=1e-9)


def test_estimates():
    x = np.array([0.5, 1, 1.5, 7.25, 1000.5, 1e9])
    assert np.allclose(treeweight.lgamma(x), [math.lgamma(i) for i in x], rtol=1e-13, atol=1e-12)
    assert np.allclose(treeweight.estimate(np.array([0.0, 1, 2]), np.array([0.0, 1, 3])), np.log([1, 0.5, 0.5 * 0.25 * 0.75 / 1.5]))


def test_language_model_on_long_texts_and_slices(docs, monkeypatch):
    texts = pa.array([t for _, t in DOCS] + ["long text " * 3000], pa.large_string())
    rows = pa.record_batch({"doc_id": list(range(len(texts))), "held_out": [i % 3 == 0 for i in range(len(texts))]})

    def made():
        batch = treeweight._Batch(1, 3)
        batch.add(rows, texts)
        out = pa.Table.from_batches(batch.done()).to_pandas()
        runs = out[out.kind == treeweight.RUN].sort_values("key").astype({"key": "int64", "n": "int64"})
        nodes = pa.Table.from_batches(treeweight._deep([pa.record_batch({"key": k, "n": n}) for k, n in (
            (runs.key[i : i + 40], runs.n[i : i + 40]) for i in range(0, len(runs), 40))], 3)).to_pandas()
        return runs, nodes[nodes.kind == treeweight.RUN].sort_values("key"), nodes[nodes.kind == 0].sort_values(["key", "node"])

    whole = made()
    monkeypatch.setattr(treeweight, "SLICE", 1000)
    monkeypatch.setattr(treeweight, "TOGETHER", 50)
    parts = made()
    assert whole[0][["key", "n"]].values.tolist() == parts[0][["key", "n"]].values.tolist()
    assert np.allclose(np.stack(whole[1].p), np.stack(parts[1].p))
    assert np.allclose(whole[2][["key", "node", "ones", "total", "weighted"]].astype(float), parts[2][["key", "node", "ones", "total", "weighted"]].astype(float))
    long = treeweight.report(docs.where("doc_id = 8").withColumn("text", F.expr("repeat(text, 40)"))).first()
    assert long.n_bytes > treeweight.SLICE and long.bits_per_byte < 0.2


def test_language_model_without_training_or_rows(spark, docs):
    got = treeweight.report(docs.where("doc_id IS NULL")).collect()
    assert [(r.train_tokens, r.n_known, r.base_score) for r in got] == [(0, 0, 0.0)] * 2
    assert sorted(r.score for r in got)[1] == pytest.approx(8 * math.log10(0.5))
    assert treeweight.report(docs.limit(0)).count() == 0


def test_language_model_learns(spark):
    got = QUERIES["op11_language_model"](spark, SF).toPandas()
    out = got[got.held_out]
    shuffled = out.n_bytes.sum() * 8
    assert 0 < -out.score.sum() / math.log10(2) < 0.5 * shuffled  # under four bits a byte on texts never seen


# --- radix tree and trie


def test_radix_tree_layouts_and_paths():
    rng = random.Random(3)
    keys = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(6))) for _ in range(400)]
    keys += [b"ab" + bytes([i]) + b"tail" for i in range(256)] + [b"zz" + bytes([i]) for i in range(40)] + [b"yy" + bytes([i]) for i in range(9)]
    rng.shuffle(keys)
    tree, want = radix.Tree(), defaultdict(list)
    for i, k in enumerate(keys):
        tree.add(k, i)
        want[k].append(i)
    got, kinds, order = {}, set(), []

    def walk(node, prefix):
        if node.ends:
            got[prefix] = node.ends
            order.append(prefix)
        else:
            assert node is tree.root or len(node.below()) > 1  # single paths are compressed
        kinds.add(type(node.children))
        for n in node.below():
            walk(n, prefix + n.path)

    walk(tree.root, b"")
    assert got == want and order == sorted(want)
    assert kinds == {type(None), radix.Sorted4, radix.Sorted16, radix.Indexed48, radix.Direct256}


def trie(rows):
    own, conv = defaultdict(list), {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [x[1] for x in sorted(v)] for c, v in own.items()}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        conv[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    nodes, kids, leaves, saved = defaultdict(list), defaultdict(set), Counter(), Counter()
    for c, t in conv.items():
        for d in range(len(t) + 1):
            nodes[t[:d]].append(c)
            if d:
                kids[t[: d - 1]].add(t[:d])
    for n, m in nodes.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in kids
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1].encode()) if n else 0
    return sorted(
        repr((min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), len(kids.get(n, ())), leaves[n], saved[n],
              sha(",".join(map(str, sorted(c for c in m if conv[c] == n))))))
        for n, m in nodes.items()
    )


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(5)
    rows = []
    for c in range(400):
        if c % 5 == 0 and c % 3 == 0:
            continue  # absent bases
        for turn in range(rng.choice([1, 1, 2, 4, 9, 12, 40])):
            rows.append((c, turn, rng.choice(["user", "bot", None]), rng.choice(["hi", "yes", "", None, "é" * 9, "no\nway"])))
    rows += [(c, 0, "user", "same") for c in range(400, 700)] + [(701, None, "user", "first"), (701, 0, None, None), (701, 0, None, None)]
    rows += [(None, 1, "user", "nobody"), (None, None, None, None), (702, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    return rows, df.withColumns({c: F.lit(1) for c in "key node above base t ids block part n_convs h sizes".split()})


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 1, "range_bytes": 2000}, {"block_bytes": 3000, "range_bytes": 20000}])
def test_trie_against_brute_force(talks, sizes):
    rows, df = talks
    assert sorted(repr(tuple(r)) for r in tries.report(df, **sizes).collect()) == trie(rows)


def test_trie_of_nothing(talks):
    assert tries.report(talks[1].limit(0)).count() == 0
    assert tries.report(talks[1].where("conv_id IS NULL")).count() == 0


# --- alignment


def alignments(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{align.FOLDER}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{align.FOLDER}/piece_bpe_32k.model")
    letters = {chr(i): i for i in align.PLAIN}
    letters |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in align.PLAIN)}
    found, held_by = [], Counter()
    for i, t in rows:
        links, groups, n_a, n_b = Counter(), [], 0, 0
        if t:
            x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            pa = [bytes(letters[c] for c in a.id_to_token(k)) for k in x]
            pb = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in y]
            if b"".join(pa) == b"".join(pb) == (" " + t).encode():
                ea, eb = np.cumsum([len(p) for p in pa]).tolist(), np.cumsum([len(p) for p in pb]).tolist()
                n_a, n_b, low = len(x), len(y), 0
                for cut in sorted(set(ea) & set(eb)):
                    in_a = [(k, e - len(p), e) for k, p, e in zip(x, pa, ea) if low < e <= cut]
                    in_b = [(k, e - len(p), e) for k, p, e in zip(y, pb, eb) if low < e <= cut]
                    groups.append(",".join(str(k[0]) for k in in_a) + "|" + ",".join(str(k[0]) for k in in_b))
                    links.update((p[0], q[0]) for p in in_a for q in in_b if p[1] < q[2] and q[1] < p[2])
                    low = cut
        found.append((i, n_a, n_b, groups, links))
        held_by.update(links.keys())
    top = defaultdict(int)
    for (x, _), n in held_by.items():
        top[x] = max(top[x], n)
    return sorted(
        repr((i, n_a, n_b, len(g), sum(links.values()), sum(n for p, n in links.items() if held_by[p] == top[p[0]]),
              sum(n * held_by[p] for p, n in links.items()), sha(";".join(g)) if g else ""))
        for i, n_a, n_b, g, links in found
    )


@pytest.mark.parametrize("limit", [None, 1, 60])
def test_alignment_against_brute_force(docs, limit):
    few = [(i, t) for i, t in DOCS if not t or len(t) < 1000]
    got = align.report(docs.where("text IS NULL OR length(text) < 1000"), limit=limit).collect()
    assert sorted(repr(tuple(r)) for r in got) == alignments(few)


def test_alignment_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 600").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(repr(tuple(r)) for r in align.report(df).collect()) == alignments(rows)


def test_alignment_of_long_texts_and_nothing(docs):
    got = align.report(docs.where("doc_id = 8")).first()
    assert got.n_a > 5000 and 0 < got.n_groups <= min(got.n_a, got.n_b) and got.n_best <= got.n_links
    assert align.report(docs.limit(0)).count() == 0


def test_pointers_end_where_both_end():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.r_[rng.integers(1, n + 1, rng.integers(1, 30)), n]) for _ in range(2))
        last = align.terminals(a, b)
        cuts = np.intersect1d(a, b)
        assert np.array_equal(b[last], cuts[np.searchsorted(cuts, np.r_[a, b])])
        x, y = align.overlaps(a, b)
        sa, sb = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < b[j] and sb[j] < a[i]}
        assert set(zip(x.tolist(), y.tolist())) == want and len(x) == len(want)
