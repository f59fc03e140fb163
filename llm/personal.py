"""Personal data: patterns, and a character-level BiLSTM-CRF that adds what they miss.

The tagger learns from labelled spans in windows of a bounded sample of documents, with numpy on the driver: the patterns'
spans where they stand, and the same spans respelled by rule in ways that no pattern knows (spaces around an address's
marks, bracketed dots, other marks between a card's digits, numbers without their plus; see `respelled`). Texts are cut into windows of WINDOW code points, half of which overlap. Every span of the four kinds holds a digit
or an at sign and the tagger's spans must too, so windows without either cannot give one and are not scored. The scores of
overlapping windows are averaged, nearer the middle weighing more, and runs of neighbouring windows are decoded in long
overlapping sequences, so spans are whole across window borders. A tagged span is added if its kind's parts are there (see `plausible`)
and no pattern's span overlaps it.

A null or empty text has no spans. Repeated rows are judged alike. Without sampled spans nothing is added. Very long texts,
also such as are full of digits, are scored and decoded in parts of bounded size. Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.frames import map_texts
from llm.tagger import Tagger, classes
from llm.words import raw

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32

_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # start, place in KINDS, end


@dataclass(frozen=True)
class Training:
    """docs: documents looked at for labelled windows; windows: at most so many are learnt from, half of them at most
    without a span."""

    docs: int = 20000
    windows: int = 2400
    hidden: int = 16
    steps: int = 450
    batch: int = 96


def _emails(text: str):
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _part(digits: str) -> int:
    """The value of a part of an address; leading zeros count for nothing and 256 stands for all longer ones."""
    rest = digits.lstrip("0")
    return 256 if len(rest) > 3 else int(rest or "0")


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by start and kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(_part(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


_MAIL = re.compile(r"[^@\s]+\s?@\s?[^@\s.]+(?:\s?\.\s?[^@\s.]+)+")
_DOTTED = re.compile(r"([0-9]+)\s?\[?\.\]?\s?([0-9]+)\s?\[?\.\]?\s?([0-9]+)\s?\[?\.\]?\s?([0-9]+)")
_NUMBER = re.compile(r"[0-9](?:[\x20./-]{0,3}[0-9])+")
_DIAL = re.compile(r"(?:\+\s?)?[0-9(][\x20().0-9/-]+[0-9]")


def plausible(kind: int, text: str) -> bool:
    """What a tagged span must hold to be added."""
    if text != text.strip():
        return False
    if kind == 0:
        return _MAIL.fullmatch(text) is not None
    if kind == 1:
        m = _DOTTED.fullmatch(text)
        return m is not None and all(_part(p) <= 255 for p in m.groups())
    digits = _digits(text)
    if kind == 2:
        return 12 <= len(digits) <= 19 and _NUMBER.fullmatch(text) is not None and luhn(digits)
    return 9 <= len(digits) <= 15 and _DIAL.fullmatch(text) is not None


def _respell(kind: int, text: str, way: int) -> str:
    if kind == 0:
        at, way = text.index("@"), way % 4
        mark, dot = ((" @ ", "."), ("@", " . "), (" @ ", " . "), (" @", "."))[way]
        return text[:at] + mark + text[at + 1 :].replace(".", dot)
    if kind == 1:
        return text.replace(".", ("[.]", " . ", ". ", " .")[way % 4])
    digits = _digits(text)
    if kind == 2:
        return (".", " - ", "/", "  ")[way % 4].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    rest = text[1:]
    return ("00" + rest, rest.replace(" ", "/").replace("-", "/"), "+ " + rest, "00" + re.sub("[ -]", ".", rest))[way % 4]


def respelled(text: str) -> tuple[str, list[Span]]:
    """The text with its patterns' spans respelled, in a way that each span's own characters choose, and where they are now.

    Spans that overlap an earlier one, and kinds that would be the same in the new spelling, stay as they are and count for
    nothing."""
    out, spans, at, size = [], [], 0, 0
    for start, kind, end in base_spans(text):
        old = text[start:end]
        new = _respell(kind, old, zlib.crc32(old.encode()))
        if start < at or new == old:
            continue
        out += [text[at:start], new]
        size += start - at
        spans.append((size, kind, size + len(new)))
        size, at = size + len(new), end
    out.append(text[at:])
    return "".join(out), spans


def _marked(points: np.ndarray) -> np.ndarray:
    """Numbers of the windows that hold a digit or an at sign, from the classes of a text."""
    at = np.flatnonzero((points == 3) | (points == 4))
    if not len(at):
        return at
    last = at // STRIDE
    near = np.concatenate([last - 1, last])  # windows start at multiples of STRIDE and are two of them long
    return np.unique(near[near >= 0])


def _cut(points: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    padded = np.concatenate([points, np.zeros(WINDOW, points.dtype)])
    return padded[numbers[:, None] * STRIDE + np.arange(WINDOW)]


def _tags(spans: list[Span], n: int) -> np.ndarray:
    out = np.zeros(n, np.uint8)
    for start, kind, end in reversed(spans):  # where spans overlap the first in order wins
        out[start:end] = 2 * kind + 2
        out[start] = 2 * kind + 1
    return out


def fit(docs: DataFrame, p: Training = Training()) -> Tagger | None:
    """Learn from labelled windows of the documents with the smallest hashes of their ids; None if there is no span."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    order = [F.xxhash64(F.col("doc_id"), F.lit(13)), F.col("doc_id")]
    taken = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids.orderBy(*order).limit(p.docs)), "doc_id")

    def fn(rows, texts):
        held = []
        for text in texts.to_pylist():
            own = base_spans(text or "")
            made = []
            for form, spans in [(text or "", own), *([respelled(text)] if own else [])]:
                points = classes(form)
                numbers = _marked(points)
                both = np.hstack([_cut(points, numbers), _cut(_tags(spans, len(points)), numbers)]) if len(numbers) else points[:0]
                made += [x.tobytes() for x in both]
            held.append(made)
        return [held]

    made = map_texts(taken, fn, [T.StructField("w", T.ArrayType(T.BinaryType()))], ["doc_id"])
    made = made.select(F.explode("w").alias("w")).distinct()
    spans = F.hex(F.substring(F.col("w"), WINDOW + 1, WINDOW)).rlike("[1-9A-F]")
    key = F.xxhash64("w")
    good = made.where(spans).orderBy(key, "w").limit(p.windows - p.windows // 3)
    none = made.where(~spans).orderBy(key, "w").limit(p.windows // 3)
    rows = sorted(bytes(r["w"]) for r in good.unionByName(none).collect())
    both = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 2 * WINDOW)
    y = both[:, WINDOW:].astype(np.int64)
    if not y.any():
        return None
    model = Tagger.new(2 * len(KINDS) + 1, p.hidden)
    model.train(both[:, :WINDOW].astype(np.int64), y, p.steps, p.batch, 0.03)
    return model


_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]
#: Neighbouring windows that are decoded as one sequence, and how many of them the next sequence starts with again.
BLOCK, AGAIN = 32, 6
SCORED = 8192


def _merged(e: np.ndarray) -> np.ndarray:
    """Scores of the code points under neighbouring windows: the mean of the two windows on each, by nearness to their middle."""
    n, _, tags = e.shape
    total = np.zeros((n + 1, STRIDE, tags), np.float32)
    weight = np.zeros((n + 1, STRIDE, 1), np.float32)
    for part, half in ((slice(0, n), slice(0, STRIDE)), (slice(1, n + 1), slice(STRIDE, WINDOW))):
        total[part] += e[:, half] * _WEIGHT[half]
        weight[part] += _WEIGHT[half]
    return (total / weight).reshape(-1, tags)


def _decoded(model: Tagger, runs: list[tuple[int, int, np.ndarray]]) -> list[np.ndarray]:
    """Tags of each run's code points. Runs are decoded in sequences of BLOCK windows that share AGAIN of them with the next;
    up to the middle of what they share the former's tags hold, from there the latter's, which saw as much on both sides."""
    step, parts = (BLOCK - AGAIN) * STRIDE, []  # parts: run, first code point, scores
    for r, (_, _, scores) in enumerate(runs):
        for at in range(0, max(1, len(scores) - (AGAIN + 1) * STRIDE), step):
            parts.append((r, at, scores[at : at + (BLOCK + 1) * STRIDE]))
    out = [np.zeros(len(s), np.int8) for _, _, s in runs]
    parts.sort(key=lambda x: (len(x[2]), x[0], x[1]))
    for k in range(0, len(parts), 256):
        group = parts[k : k + 256]
        lengths = np.array([len(s) for _, _, s in group])
        padded = np.zeros((len(group), lengths.max(), group[0][2].shape[1]), np.float32)
        for j, (_, _, s) in enumerate(group):
            padded[j, : len(s)] = s
        for (r, at, s), tags in zip(group, model.decode(padded, lengths)):
            whole, half = out[r], (AGAIN + 1) * STRIDE // 2
            low = at + half if at else 0
            high = at + len(s) if at + len(s) >= len(whole) else at + step + half
            whole[low:high] = tags[low - at : high - at]
    return out


def tagged_spans(model: Tagger, texts: list[str]) -> list[list[Span]]:
    """The tagger's plausible spans of each text; at most SCORED windows are held at once."""
    out: list[list[Span]] = [[] for _ in texts]
    held: list[tuple[int, int, int, np.ndarray]] = []  # text, first code point, length, windows

    def settle():
        c = np.concatenate([w for *_, w in held])
        e = np.concatenate([model.emissions(c[a : a + 1024]) for a in range(0, len(c), 1024)])
        cuts = np.cumsum([len(w) for *_, w in held])[:-1]
        runs = [(i, start, _merged(x)[:length]) for (i, start, length, _), x in zip(held, np.split(e, cuts))]
        for (i, start, _), tags in zip(runs, _decoded(model, runs)):
            out[i] += [s for s in _read(tags, start) if plausible(s[1], texts[i][s[0] : s[2]])]
        held.clear()

    size = 0
    for i, text in enumerate(texts):
        points = classes(text)
        numbers = _marked(points)
        if len(numbers):
            for part in np.split(numbers, np.flatnonzero(np.diff(numbers) > 1) + 1):
                start = int(part[0]) * STRIDE
                held.append((i, start, min(len(points), int(part[-1]) * STRIDE + WINDOW) - start, _cut(points, part)))
                size += len(part)
                if size >= SCORED:
                    settle()
                    size = 0
    if held:
        settle()
    return [sorted(s) for s in out]


def _read(tags: np.ndarray, start: int) -> list[Span]:
    """Spans of a tag sequence: a beginning and what continues it."""
    out, at = [], 0
    for a in np.flatnonzero(tags % 2 == 1):
        if a < at:
            continue
        at = a + 1
        while at < len(tags) and tags[at] == tags[a] + 1:
            at += 1
        out.append((start + int(a), (int(tags[a]) - 1) // 2, start + int(at)))
    return out


def all_spans(model: Tagger | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Per text the patterns' spans, and all spans with the tagger's that overlap none of them."""
    extra = tagged_spans(model, texts) if model else [[] for _ in texts]
    out = []
    for text, more in zip(texts, extra):
        base = base_spans(text)
        taken, added = sorted((a, b) for a, _, b in base), []
        for s in more:
            if all(s[2] <= a or s[0] >= b for a, b in taken):
                added.append(s)
                taken.append((s[0], s[2]))
        out.append((base, sorted([*base, *added])))
    return out


def _text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def report(docs: DataFrame, p: Training = Training()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for each row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, p))

    def fn(rows, texts):
        data, offsets = raw(texts)
        held = np.concatenate([[0], np.cumsum((data == 0x40) | ((data >= 0x30) & (data <= 0x39)))])
        marked = np.flatnonzero(held[offsets[1:]] > held[offsets[:-1]])
        found: list = [([], [])] * len(texts)
        for i, spans in zip(marked, all_spans(sent.value, texts.take(pa.array(marked)).to_pylist()) if len(marked) else ()):
            found[i] = spans
        counts = [[sum(k == j for _, k, _ in base) for base, _ in found] for j in range(len(KINDS))]
        shas = [hashlib.sha256(_text(base).encode()).hexdigest() for base, _ in found]
        return [*counts, shas, [_text(every) for _, every in found]]

    longs = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    return map_texts(docs, fn, [*longs, T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())], ["doc_id"])
