"""The pipeline's stages on the small documents, each against a plain version of what it keeps."""

import re
from pathlib import Path

import pytest
import xxhash

import corpus_pipeline
from llm.frames import load, shared_folder

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
WHITE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return load(spark, SF, "documents")


def kept(spark, docs, stage):
    return {r.doc_id: r for r in STAGES[stage](spark, docs, SF).collect()}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def test_lines(spark, docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    first, judged = {}, {}
    for d in sorted(texts):
        for i, line in enumerate(texts[d].split("\n")):
            words = tuple(WHITE.findall(line.translate(LOWER)))
            if words:
                judged[d, i] = words
                first.setdefault(words, (d, i))
    by_length = {}
    for words in first:
        by_length.setdefault(len(words), []).append(words)
    least = dict(first)
    for n, lines in by_length.items():
        near = [w for m in (n - 1, n, n + 1) if m >= 3 for w in by_length.get(m, [])] if n >= 3 else []
        for a in lines:
            least[a] = min([first[a], *(first[b] for b in near if first[b] < least[a] and one_edit(a, b))])
    got = kept(spark, docs, "line dedup")
    removed = 0
    for d, text in texts.items():
        lines = text.split("\n")
        stay = [i for i in range(len(lines)) if (d, i) not in judged or least[judged[d, i]] >= (d, i)]
        removed += len(lines) - len(stay)
        left = "\n".join(lines[i] for i in stay)
        if len(stay) < len(lines) and not WHITE.search(left):
            assert d not in got
        else:
            assert got[d].text == left and (len(stay) == len(lines) or got[d].n_chars == len(left))
    assert removed > 100


def test_near_duplicates(spark, docs):
    prints = {}
    for r in docs.collect():
        w = WHITE.findall((r.text or "").translate(LOWER))
        grams = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, min(len(w), 1)))]
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[r.doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    want, seen = set(), set()
    for d in sorted(prints):  # each component is walked from its smallest id
        if d not in seen:
            want.add(d)
            todo = [d]
            while todo:
                p = prints[todo.pop()]
                near = [x for x in prints if x not in seen and (prints[x] ^ p).bit_count() <= 3]
                seen.update(near)
                todo += near
    assert set(kept(spark, docs, "SimHash near-dedup")) == want and len(want) < len(prints)


def test_benchmark(spark, docs):
    windows = set()
    for r in load(spark, SF, "benchmark").collect():
        w = WORD.findall((r.text or "").translate(LOWER))
        windows |= {tuple(w[i : i + 10]) for i in range(max(len(w) - 9, min(len(w), 1)))}
    sizes = {len(w) for w in windows}
    want = set()
    for r in docs.collect():
        w = WORD.findall((r.text or "").translate(LOWER))
        if not any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1)):
            want.add(r.doc_id)
    got = kept(spark, docs, "benchmark decontamination")
    assert set(got) == want and 0 < len(want) < docs.count()


def test_run_is_the_stages_in_order(spark, docs):
    step = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, step, SF).select("doc_id", "text").collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            left = {r.doc_id for r in rows}
            full = stage(spark, step, SF)
            step = spark.createDataFrame(full.collect(), full.schema)
            assert {r.doc_id for r in step.collect()} == left  # a stage gives the same rows each time
    shared = Path(shared_folder(spark))
    before = set(shared.glob("pipeline-*"))
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.run(spark, SF).collect())
    (own,) = set(shared.glob("pipeline-*")) - before
    assert [f.name for f in own.iterdir()] == [str(len(corpus_pipeline.STAGES) - 2)]  # the last stage's input
    assert got == sorted((r.doc_id, r.text) for r in rows) and got
