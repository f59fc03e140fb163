"""Mixing to target weights with soft membership.

A softmax classifier on the words that tell the classes of the labelled table apart, learnt from a bounded sample of it,
predicts how much of a document belongs to each domain. Then each document gets a rate >= 0, how often it should be read, so that the expected tokens per
domain (rate x words x membership, summed over all documents) come to the target weights of the present total.

The rates solve a nonnegative least squares problem by projected gradient descent, from rates of 1. Its state per document
is the document's words and memberships, its gradient per step one vector with a number per domain: a step is one
aggregation over all documents, and only that vector reaches the driver. Scaled by the inverse of the domains' second
moments (a symmetric K x K matrix, one aggregation), the step size is 1 and, with momentum, some twenty steps suffice. Steps
read a narrow copy without texts, in which every eighth step stores each document's rate and momentum.

Domains are the classes of the labelled table: "clean" (quality 1, not toxic), "toxic" (toxic), "low" (quality 0, not
toxic). Null or empty texts have no words, and the classifier's membership for an empty text; their rate follows the same
rule and weighs nothing. Domains that no labelled row has are left out and the other weights keep their proportions.
Without labelled rows all rates are 1. Targets that no rates >= 0 can meet are met as nearly as can be, with a warning that
names the shares reached. Very long texts are counted piece by piece. Repeated rows get equal rates; extra columns pass through; an empty table stays so.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.frames import fresh, map_texts, saved
from llm.labelled import sample, within
from llm.words import lower_word_table, split, white_table, word_hashes

DOMAINS = ("clean", "toxic", "low")
#: Steps that a pass replays at most before rate and momentum are stored.
EVERY = 8
TARGETS = {"clean": 0.96, "toxic": 0.01, "low": 0.03}


@dataclass(frozen=True)
class Mixing:
    """rows: labelled documents per class that are learnt from; terms: words that the classifier looks at. steps: gradient steps at most; tolerance: largest miss of
    a domain's tokens, as a share of all tokens, at which they end."""

    targets: dict[str, float] = field(default_factory=lambda: dict(TARGETS))
    rows: int = 1000
    terms: int = 2000
    epochs: int = 300
    steps: int = 60
    tolerance: float = 1e-6


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each different term of each text: words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with A-Z lowered, the
    marks that end a word, all capitals, and words that follow themselves."""
    plain = split(texts, lower_word_table())
    loose = split(texts, white_table())
    h = word_hashes(plain)
    mark = loose.data[loose.end - 1].astype(np.uint64)
    marked = (mark < 0x80) & ~np.isin(mark, _ALNUM)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (plain.owner[1:] == plain.owner[:-1])
    first, last = loose.data[loose.start], loose.data[np.maximum(loose.end - 3, loose.start)]
    loud = (first >= 0x41) & (first <= 0x5A) & (last >= 0x41) & (last <= 0x5A)
    owner = np.concatenate([plain.owner, loose.owner[marked], loose.owner[loud], plain.owner[again]])
    term = np.concatenate([h, mark[marked], np.full(int(loud.sum()), 300, np.uint64), np.full(int(again.sum()), 301, np.uint64)])
    order = np.lexsort((term, owner))
    owner, term = owner[order], term[order]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], term[new]


_ALNUM = np.array([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])


@dataclass
class Classifier:
    """terms: sorted hashes of the words looked at; weight: one row per term."""

    domains: tuple[str, ...]
    terms: np.ndarray
    weight: np.ndarray
    bias: np.ndarray

    def posterior(self, texts: pa.Array) -> np.ndarray:
        owner, term = _terms(texts)
        at = np.minimum(np.searchsorted(self.terms, term), max(len(self.terms) - 1, 0))
        known = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        owner, at = owner[known], at[known]
        if not self.domains:
            return np.zeros((len(texts), 0))
        z = np.stack([np.bincount(owner, self.weight[at, j], len(texts)) for j in range(len(self.domains))], axis=1) + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def domain() -> Column:
    """The class of a labelled row; null where quality is missing and the row is not toxic."""
    toxic, quality = F.col("toxic") == 1, F.col("quality")
    return F.when(toxic, 1).when(quality == 1, 0).when(quality == 0, 2)


def fit(docs: DataFrame, labels: DataFrame, p: Mixing = Mixing()) -> Classifier:
    """Softmax regression on the terms whose share of documents differs most between the classes (chi-square); each class
    weighs alike while learning, then the priors of the labelled rows are put in. Only labels of ids in docs count."""
    labels = saved(within(labels.select("doc_id", domain().alias("d")).where("d is not null"), docs))

    def encode(texts):
        owner, term = _terms(texts)
        return [x.tobytes() for x in np.split(term, np.searchsorted(owner, np.arange(1, len(texts))))]

    got = sample(docs, labels, F.col("d"), p.rows, encode, F.lit(True))
    known = sorted({y for _, y in got})
    names = tuple(DOMAINS[k] for k in known)
    if len(known) < 2:
        return Classifier(names, np.zeros(0, np.uint64), np.zeros((0, len(names))), np.zeros(len(names)))
    y = np.searchsorted(known, [y for _, y in got])
    sets = [np.frombuffer(f, np.uint64) for f, _ in got]
    row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])
    terms, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = column.astype(np.int32)
    often = seen[column] > 1  # a word of one document tells nothing
    row, column = row[often], column[often]
    size = np.bincount(y, minlength=len(known)).astype(float)
    share = np.stack([np.bincount(column, (y == c)[row], len(terms)) for c in range(len(known))], axis=1) / size
    mean = share.mean(1, keepdims=True)
    odd = (((share - mean) ** 2) / (mean * (1 - mean) + 1.0 / len(sets))).sum(1)
    chosen = np.sort(np.argsort(-odd, kind="stable")[: p.terms])
    place = np.full(len(terms), -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((len(sets), len(chosen)), np.float32)
    used = place[column] >= 0
    x[row[used], place[column][used]] = 1
    target = np.eye(len(known), dtype=np.float32)[y]
    share = (target / target.sum(0)).sum(1, keepdims=True) / len(known)
    w, b = np.zeros((len(chosen), len(known)), np.float32), np.zeros(len(known), np.float32)
    vw, vb, rate, keep = np.zeros_like(w), np.zeros_like(b), 0.5, 0.9
    for _ in range(p.epochs):  # gradient descent with momentum on the whole sample
        z = x @ w + b
        z = np.exp(z - z.max(1, keepdims=True))
        miss = (z / z.sum(1, keepdims=True) - target) * share
        vw = keep * vw - rate * (x.T @ miss + 1e-4 * w)
        vb = keep * vb - rate * miss.sum(0)
        w, b = w + vw, b + vb
    prior = dict(labels.groupBy("d").count().collect())
    bias = b + np.log(np.array([prior[k] for k in known], np.float64) / sum(prior.values()))
    return Classifier(names, terms[chosen], w.astype(np.float64), bias)


def memberships(docs: DataFrame, model: Classifier, p: Mixing, keep: list[str], prefix: str = "") -> DataFrame:
    """Columns `keep`, tokens (words [^\\x20\\x09-\\x0D]+) and membership (one number per domain of the model)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def fn(rows, texts):
        n = np.diff(split(texts, white_table()).first)
        return [n, list(sent.value.posterior(texts))]

    fields = [T.StructField(f"{prefix}tokens", T.LongType()), T.StructField(f"{prefix}membership", T.ArrayType(T.DoubleType()))]
    return map_texts(docs, fn, fields, keep)


def _rate(member: Column, steps: list[np.ndarray], start: tuple[Column, Column] | None = None) -> Column:
    """(rate, ahead) of a document after the given steps, from 1 or from start: rate = max(0, ahead - membership . step),
    and ahead runs on from there by the step's momentum, its last number."""
    kind = "struct<rate:double,ahead:double>"
    rate, ahead = start or (F.lit(1.0), F.lit(1.0))
    start = F.struct(rate.alias("rate"), ahead.alias("ahead")).cast(kind)
    if not steps:
        return start
    k = len(steps[0]) - 1

    def move(state: Column, step: Column) -> Column:
        pull = F.lit(0.0)
        for j in range(k):
            pull = pull + F.get(member, F.lit(j)) * F.get(step, F.lit(j))
        rate = F.greatest(F.lit(0.0), state["ahead"] - pull)
        return F.struct(rate.alias("rate"), (rate + F.get(step, F.lit(k)) * (rate - state["rate"])).alias("ahead")).cast(kind)

    return F.aggregate(F.lit([[float(v) for v in s] for s in steps]), start, move)


def solve(state: DataFrame, domains: tuple[str, ...], p: Mixing, prefix: str = "", every: int = EVERY) -> list[np.ndarray]:
    """The steps that lead from rates of 1 to the solution: accelerated projected gradient, restarted when it overshoots.

    state: tokens and membership of every document. Rate and momentum become columns of a narrow copy every `every` steps,
    so a pass reads no texts and replays fewer steps than that.
    """
    k = len(domains)
    n, member = F.col(f"{prefix}tokens").cast("double"), F.col(f"{prefix}membership")
    one = F.lit(1.0)
    held = saved(state.select(n.alias("n"), member.alias("m"), one.alias("rate"), one.alias("ahead")))
    n, member = F.col("n"), F.col("m")
    part = [F.get(member, F.lit(j)) for j in range(k)]
    cells = [F.sum(n * part[i] * part[j]) for i in range(k) for j in range(k)]
    first = held.agg(F.sum(n), *cells).first()
    total = first[0] or 0.0
    wanted = np.array([max(p.targets.get(d, 0.0), 0.0) for d in domains])
    if k < 2 or total == 0 or wanted.sum() == 0:
        return []
    target = wanted / wanted.sum()
    moment = np.array(first[1:], float).reshape(k, k) / total
    scale = np.linalg.pinv(moment, rcond=1e-9, hermitian=True)
    steps: list[np.ndarray] = []
    fresh_steps: list[np.ndarray] = []  # not yet in held's columns
    off, last, speed, before = np.inf, np.inf, 1.0, np.full(k, np.inf)
    for _ in range(p.steps):
        moved = held.select("n", "m", _rate(member, fresh_steps, (F.col("rate"), F.col("ahead"))).alias("s"))
        if len(fresh_steps) >= every:
            held = saved(moved.select("n", "m", "s.rate", "s.ahead"))
            moved, fresh_steps = held.select("n", "m", F.struct("rate", "ahead").alias("s")), []
        sums = moved.agg(
            *[F.sum(F.col("n") * F.col(f"s.{x}") * F.get(F.col("m"), F.lit(j))) for x in ("rate", "ahead") for j in range(k)]
        )
        both = np.array(sums.first(), float).reshape(2, k) / total - target
        miss, ahead = both
        error = float(miss @ scale @ miss)
        off = float(np.abs(miss).max())
        if off <= p.tolerance or np.abs(miss - before).max() <= p.tolerance / 10:
            break  # met, or as near as rates >= 0 come
        speed = 1.0 if error > last else speed
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        steps.append(np.append(scale @ ahead, (speed - 1) / faster))
        fresh_steps.append(steps[-1])
        last, speed, before = error, faster, miss
    if off > 100 * p.tolerance:
        shares = ", ".join(f"{d} {t + m:.4f} for {t:.4f}" for d, t, m in zip(domains, target, miss))
        logging.getLogger(__name__).warning("no rates meet the target shares of tokens; nearest: %s", shares)
    return steps


def rates(docs: DataFrame, labels: DataFrame, keep: list[str], p: Mixing = Mixing(), prefix: str = "") -> tuple[DataFrame, tuple[str, ...]]:
    """Columns `keep`, tokens, membership and rate for each row of docs, and the domains in the order of membership."""
    model = fit(docs, labels, p)
    state = saved(memberships(docs, model, p, [*keep], prefix))
    steps = solve(state, model.domains, p, prefix)
    return state.withColumn(f"{prefix}rate", _rate(F.col(f"{prefix}membership"), steps)["rate"]), model.domains


def copies(rate: Column, key: Column) -> Column:
    """How often a row is read: the rate's whole part, and once more with its fraction as probability, by the key's hash."""
    chance = F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def report(docs: DataFrame, labels: DataFrame, p: Mixing = Mixing()) -> DataFrame:
    """doc_id, tokens, one column p_<domain> per known domain, rate and copies."""
    out, domains = rates(docs, labels, ["doc_id"], p)
    parts = [F.get("membership", F.lit(domains.index(d))) if d in domains else F.lit(0.0) for d in DOMAINS]
    named = [c.alias(f"p_{d}") for c, d in zip(parts, DOMAINS)]
    return out.select("doc_id", "tokens", *named, "rate", copies(F.col("rate"), F.col("doc_id")).alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, p: Mixing = Mixing()) -> DataFrame:
    """Columns of docs, then rate and copies (both >= 0); rows that are read no time are left out."""
    prefix = fresh(docs, "mix_")
    out, _ = rates(docs, labels, docs.columns, p, prefix)
    rate = F.col(f"{prefix}rate")
    out = out.withColumn(f"{prefix}copies", copies(rate, F.col("doc_id"))).where(F.col(f"{prefix}copies") > 0)
    plain = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*plain, rate.alias(fresh(docs, "rate")), F.col(f"{prefix}copies").alias(fresh(docs, "copies")))
