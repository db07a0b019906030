"""Character tagger in numpy: bidirectional LSTM under a linear-chain CRF."""

from __future__ import annotations

import numpy as np

UNITS, BATCH, RATE = 24, 64, 0.02


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


class Tagger:
    """``symbols`` input symbols, ``tags`` output tags; windows are arrays [window][place] of symbols."""

    def __init__(self, symbols: int, tags: int, seed: int = 7) -> None:
        r, h = np.random.default_rng(seed), UNITS
        draw = lambda *shape: (r.standard_normal(shape) * (1 / shape[0]) ** 0.5).astype(np.float32)
        self.w: dict[str, np.ndarray] = {}
        for side in "fb":  # forward and backward reading
            self.w[f"x{side}"] = (r.standard_normal((symbols, 4 * h)) * 0.3).astype(np.float32)
            self.w[f"h{side}"] = draw(h, 4 * h)
            self.w[f"c{side}"] = np.repeat([0, 1, 0, 0], h).astype(np.float32)  # gates: in, forget, out, new
        self.w["o"], self.w["b"] = draw(2 * h, tags), np.zeros(tags, np.float32)
        self.w["t"], self.w["s"] = np.zeros((tags, tags), np.float32), np.zeros(tags, np.float32)
        # Tag 0 is outside, then first and further places of each kind. Learning starts where only a first place opens a span.
        inner = np.arange(2, tags, 2)
        self.w["t"][:, inner] = self.w["s"][inner] = -6
        self.w["t"][inner - 1, inner] = self.w["t"][inner, inner] = 1

    def _read(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        n, length = x.shape
        h, c, u = np.zeros((n, UNITS), np.float32), np.zeros((n, UNITS), np.float32), UNITS
        out, kept = np.zeros((length, n, UNITS), np.float32), []
        wx, wh, bias = self.w[f"x{side}"], self.w[f"h{side}"], self.w[f"c{side}"]
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            z = wx[x[:, t]] + h @ wh + bias
            gates = _sigmoid(z[:, : 3 * u])
            new = np.tanh(z[:, 3 * u:])
            before = c
            c = gates[:, u: 2 * u] * c + gates[:, :u] * new
            flat = np.tanh(c)
            kept.append((t, h, before, gates, new, flat))
            h = gates[:, 2 * u:] * flat
            out[t] = h
        return out, kept

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Emission scores [place][window][tag]."""
        return np.concatenate([self._read(x, "f")[0], self._read(x, "b")[0]], 2) @ self.w["o"] + self.w["b"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tags [window][place]."""
        e = self.scores(x)
        best, back = e[0] + self.w["s"], []
        for t in range(1, len(e)):
            step = best[:, :, None] + self.w["t"]
            back.append(step.argmax(1))
            best = step.max(1) + e[t]
        tags = np.zeros((x.shape[1], x.shape[0]), np.int64)
        tags[-1] = best.argmax(1)
        rows = np.arange(x.shape[0])
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = back[t - 1][rows, tags[t]]
        return tags.T

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, length = x.shape
        ff, keptf = self._read(x, "f")
        fb, keptb = self._read(x, "b")
        both = np.concatenate([ff, fb], 2)
        e = both @ self.w["o"] + self.w["b"]
        trans = self.w["t"]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[0] = e[0] + self.w["s"]
        for t in range(1, length):
            alpha[t] = _lse(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(length - 2, -1, -1):
            beta[t] = _lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _lse(alpha[-1], 1)
        grad = np.exp(alpha + beta - total[:, None])
        g: dict[str, np.ndarray] = {k: np.zeros_like(v) for k, v in self.w.items()}
        for t in range(1, length):
            pair = alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - total[:, None, None]
            g["t"] += np.exp(pair).sum(0)
            np.add.at(g["t"], (y[:, t - 1], y[:, t]), -1)
        rows = np.arange(n)
        for t in range(length):
            grad[t, rows, y[:, t]] -= 1
        g["s"] = grad[0].sum(0)
        g["o"], g["b"] = np.einsum("tnh,tnk->hk", both, grad), grad.sum((0, 1))
        inner = grad @ self.w["o"].T
        for side, kept, part in (("f", keptf, inner[:, :, :UNITS]), ("b", keptb, inner[:, :, UNITS:])):
            u, dh, dc, wh = UNITS, np.zeros((n, UNITS), np.float32), np.zeros((n, UNITS), np.float32), self.w[f"h{side}"]
            for t, h, before, gates, new, flat in reversed(kept):
                dh = dh + part[t]
                i, f, o = gates[:, :u], gates[:, u: 2 * u], gates[:, 2 * u:]
                dc = dc + dh * o * (1 - flat * flat)
                dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dh * flat * o * (1 - o), dc * i * (1 - new * new)], 1)
                # Rows of equal symbols are summed by a product with their flags.
                seen, which = np.unique(x[:, t], return_inverse=True)
                g[f"x{side}"][seen] += (which == np.arange(len(seen))[:, None]).astype(np.float32) @ dz
                g[f"h{side}"] += h.T @ dz
                g[f"c{side}"] += dz.sum(0)
                dh, dc = dz @ wh.T, dc * f
        return {k: v / n for k, v in g.items()}

    def train(self, x: np.ndarray, y: np.ndarray, steps: int, seed: int = 11) -> None:
        """Adam on the negative log-likelihood of tags ``y`` of windows ``x``."""
        r = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            at = r.integers(0, len(x), min(BATCH, len(x)))
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in self._gradients(x[at], y[at]).items():
                g = np.clip(g, -5, 5)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.w[k] = (self.w[k] - rate * move).astype(np.float32)
