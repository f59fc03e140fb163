"""A character-level bidirectional LSTM with CRF transitions, trained in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CLASSES = 17
_ASCII = np.full(128, 13, np.uint8)
_ASCII[[*range(0x61, 0x7B)]] = 1
_ASCII[[*range(0x41, 0x5B)]] = 2
_ASCII[[*range(0x30, 0x3A)]] = 3
for _i, _c in enumerate("@.-+"):
    _ASCII[ord(_c)] = 4 + _i
_ASCII[[ord("_"), ord("%")]] = 8
_ASCII[ord(" ")] = 9
_ASCII[ord("(")], _ASCII[ord(")")] = 10, 11
_ASCII[[9, 10, 11, 12, 13]] = 12
_ASCII[[ord(":"), ord("="), ord("/")]] = 15
_ASCII[[ord(c) for c in "\"'"]] = 16


def classes(text: str) -> np.ndarray:
    """A class per code point; 0 is kept for what lies beyond a text's end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _ASCII[np.minimum(points, 127)], 14).astype(np.uint8)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * z) + 1)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """wx, wh, b: one set per direction; wo, bo: from both directions to tags; trans, first, last: the CRF."""

    p: dict[str, np.ndarray]
    hidden: int

    @classmethod
    def new(cls, tags: int, hidden: int, seed: int = 5) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {"wo": rng.normal(0, 0.2, (2 * hidden, tags)), "bo": np.zeros(tags), "trans": np.zeros((tags, tags))}
        p |= {"first": np.zeros(tags), "last": np.zeros(tags)}
        for d in "fb":
            p[f"wx{d}"] = rng.normal(0, 0.3, (CLASSES, 4 * hidden))
            p[f"wh{d}"] = rng.normal(0, 0.2, (hidden, 4 * hidden))
            p[f"b{d}"] = np.zeros(4 * hidden)
            p[f"b{d}"][hidden : 2 * hidden] = 1  # remember at first
        return cls({k: v.astype(np.float32) for k, v in p.items()}, hidden)

    def _pass(self, c: np.ndarray, d: str):
        n, length = c.shape
        size = self.hidden
        x = self.p[f"wx{d}"][c] + self.p[f"b{d}"]
        h, s = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
        out, kept = np.empty((n, length, size), np.float32), []
        for t in range(length):
            z = x[:, t] + h @ self.p[f"wh{d}"]
            gate, g = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
            i, f, o = gate[:, :size], gate[:, size : 2 * size], gate[:, 2 * size :]
            old, s = s, f * s + i * g
            ts = np.tanh(s)
            kept.append((h, old, i, f, o, g, ts))
            h = o * ts
            out[:, t] = h
        return out, kept

    def emissions(self, c: np.ndarray) -> np.ndarray:
        """Scores (windows, places, tags) of class windows."""
        forth, back = self._pass(c, "f")[0], self._pass(c[:, ::-1], "b")[0][:, ::-1]
        return np.concatenate([forth, back], 2) @ self.p["wo"] + self.p["bo"]

    def gradients(self, c: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag sequences y, and its gradients."""
        p, size = self.p, self.hidden
        n, length = c.shape
        forth, kept_f = self._pass(c, "f")
        back, kept_b = self._pass(c[:, ::-1], "b")
        both = np.concatenate([forth, back[:, ::-1]], 2)
        e = both @ p["wo"] + p["bo"]
        alpha, beta = np.empty_like(e), np.empty_like(e)
        alpha[:, 0] = e[:, 0] + p["first"]
        for t in range(1, length):
            alpha[:, t] = e[:, t] + _logsum(alpha[:, t - 1, :, None] + p["trans"], 1)
        beta[:, -1] = p["last"]
        for t in range(length - 2, -1, -1):
            beta[:, t] = _logsum(p["trans"] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = _logsum(alpha[:, -1] + p["last"], 1)
        rows, places = np.arange(n)[:, None], np.arange(length)
        gold = e[rows, places, y].sum(1) + p["first"][y[:, 0]] + p["last"][y[:, -1]] + p["trans"][y[:, :-1], y[:, 1:]].sum(1)
        marginal = np.exp(alpha + beta - z[:, None, None])
        g = {k: np.zeros_like(v) for k, v in p.items()}
        pairs = np.exp(alpha[:, :-1, :, None] + p["trans"] + (e + beta)[:, 1:, None, :] - z[:, None, None, None])
        g["trans"] = pairs.sum((0, 1)) / n
        np.add.at(g["trans"], (y[:, :-1], y[:, 1:]), -1 / n)
        de = marginal.copy()
        de[rows, places, y] -= 1
        g["first"], g["last"] = de[:, 0].sum(0) / n, (marginal[:, -1].sum(0) - np.bincount(y[:, -1], minlength=e.shape[2])) / n
        de /= n
        g["wo"] = np.einsum("nth,ntk->hk", both, de)
        g["bo"] = de.sum((0, 1))
        dboth = de @ p["wo"].T
        for d, dh_all, kept, cc in (("f", dboth[:, :, :size], kept_f, c), ("b", dboth[:, ::-1, size:], kept_b, c[:, ::-1])):
            dh, ds = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
            dz_all = np.empty((n, length, 4 * size), np.float32)
            for t in range(length - 1, -1, -1):
                h, old, i, f, o, gg, ts = kept[t]
                dh = dh + dh_all[:, t]
                ds = ds + dh * o * (1 - ts * ts)
                dz = np.concatenate([ds * gg * i * (1 - i), ds * old * f * (1 - f), dh * ts * o * (1 - o), ds * i * (1 - gg * gg)], 1)
                dz_all[:, t] = dz
                g[f"wh{d}"] += h.T @ dz
                dh, ds = dz @ p[f"wh{d}"].T, ds * f
            np.add.at(g[f"wx{d}"], cc.ravel(), dz_all.reshape(-1, 4 * size))
            g[f"b{d}"] = dz_all.sum((0, 1))
        return float((z - gold).mean()), g

    def train(self, c: np.ndarray, y: np.ndarray, steps: int, batch: int, rate: float = 0.02, seed: int = 3) -> float:
        """Adam on batches in a fixed order; the last loss."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        loss = 0.0
        for step in range(1, steps + 1):
            at = rng.integers(0, len(c), min(batch, len(c)))
            loss, g = self.gradients(c[at], y[at])
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] * g[k]
                move = now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
                self.p[k] = (self.p[k] - move).astype(np.float32)
        return loss

    def decode(self, e: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Best tag sequences of padded score rows (rows, places, tags)."""
        n, length, tags = e.shape
        best = e[:, 0] + self.p["first"]
        came = np.zeros((n, length, tags), np.int8)
        final = np.where((lengths == 1)[:, None], best, 0)
        for t in range(1, length):
            ways = best[:, :, None] + self.p["trans"]
            came[:, t] = ways.argmax(1)
            best = ways.max(1) + e[:, t]
            final = np.where((lengths == t + 1)[:, None], best, final)
        tag = (final + self.p["last"]).argmax(1)
        out = np.zeros((n, length), np.int8)
        for t in range(length - 1, -1, -1):
            inside = t < lengths
            out[:, t] = np.where(inside, tag, 0)
            if t:
                tag = np.where(inside, came[np.arange(n), t, tag], tag)
        return [out[i, :k] for i, k in enumerate(lengths)]
