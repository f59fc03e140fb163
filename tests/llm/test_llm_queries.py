"""The dealt queries against their SQL or a brute-force version, on the small tables."""

import hashlib
import re

import duckdb
import pytest
import xxhash

import __spark_entry__ as entry
import corpus_pipeline
from llm import personal
from llm.licenses import PHRASES
from llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WHITE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def rows(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF).collect()}


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_every_operator_is_registered():
    numbers = sorted(int(m[1]) for k in entry.queries() if (m := re.match(r"op(\d+)_", k)))
    assert numbers == list(range(1, 14)) and entry.queries()["pipeline"] is corpus_pipeline.run
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "documents benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    cur = con.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = [tuple(r[names.index(c)] for c in sorted(names)) for r in cur.fetchall()]
    got = [tuple(r[c] for c in sorted(names)) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_licenses(spark, texts):
    got = rows(spark, "op2_license_scan")
    assert set(got) == set(texts)
    for d, text in texts.items():
        w = WORD.findall(text.translate(LOWER))
        hits = [(i, v) for k, v in PHRASES.items() for i in range(len(w)) if w[i : i + len(k.split())] == k.split()]
        r, starts = got[d], [i for i, _ in hits]
        assert (r.n_words, r.n_base) == (len(w), len(hits))
        assert (r.first_word, r.last_word) == (min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({v for _, v in hits}))
        assert {v for _, v in hits} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_personal_data(spark, texts):
    plain = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def good(k, m):
        n = len(re.sub("[^0-9]", "", m))
        return k == 0 or k == 1 and all(int(x) <= 255 for x in m.split(".")) or k == 2 and 12 <= n <= 19 and personal.luhn(re.sub("[^0-9]", "", m)) or k == 3 and 9 <= n <= 15

    got = rows(spark, "op4_personal_data")
    for d, text in texts.items():
        base = sorted((m.start(), k, m.end()) for k, p in enumerate(plain) for m in re.finditer(p, text) if good(k, m[0]))
        listed = ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert got[d].base_sha256 == sha(listed)
        assert [got[d][f"n_{k}"] for k in personal.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]
        assert {x for x in listed.split(",") if x} <= set(got[d].spans.split(","))


def test_simhash(spark, texts):
    prints = {}
    for d, text in texts.items():
        w = WHITE.findall(text.translate(LOWER))
        shingles = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, min(len(w), 1)))]
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = rows(spark, "op5_simhash_near_dedup")
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{p:016x}", find(d)) for d, p in prints.items()}


def test_fingerprints(spark, texts):
    got = rows(spark, "op6_document_fingerprints")
    ids = sorted(texts, reverse=True)
    by_text = {}
    for i, d in enumerate(ids):
        text, following = texts[d], texts[ids[(i + 1) % len(ids)]]
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        a, b, c = (set(x.split("\n")) for x in (text, edited, following))
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha(edited))
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b)) and r.near_next == pytest.approx(len(a & c) / len(a | c))
        digest = lambda x: (lambda h: h - (h >> 63 << 64))(xxhash.xxh64_intdigest(x.encode(), seed=42))
        assert (r.lost, r.gained) == (sorted(map(digest, a - b)), sorted(map(digest, b - a)))
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op9_quality_classifier"](spark, sf).collect()}
    import zlib

    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [(r.quality, got[r.doc_id].predicted) for r in labels if r.doc_id in got and got[r.doc_id].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) >= 0.95


def test_mixing_meets_targets(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op10_mixing_weights"](spark, sf).toPandas()
    total = out.tokens.sum()
    from llm.mixing import TARGETS

    for d, share in TARGETS.items():
        assert (out.tokens * out.rate * out[f"p_{d}"]).sum() / total == pytest.approx(share, abs=0.005)
    assert (out.rate >= 0).all() and (abs(out.copies - out.rate) < 1).all()


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        rows_ = out.collect()
        assert 0 < len(rows_) <= docs.count()
        if i + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = spark.createDataFrame(rows_, out.schema)
    final = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()} == final
