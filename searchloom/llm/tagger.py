"""A character tagger in NumPy: two LSTMs, one in each direction, under a CRF.

Windows are arrays ``(windows, length)`` of character codes; sequences run along the
second axis, and all windows of a batch take a step together.
"""

from __future__ import annotations

import numpy as np

ALPHABET = 131
LETTER, OTHER, PAD = 128, 129, 130


def codes(text: str) -> np.ndarray:
    """ASCII as it is; other letters and other characters are one code each."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = points.astype(np.int64)
    beyond = np.flatnonzero(points > 127)
    if len(beyond):
        out[beyond] = [LETTER if text[i].isalpha() else OTHER for i in beyond.tolist()]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Tagger:
    """Parameters, forward and backward pass, and decoding."""

    def __init__(self, labels: int, hidden: int = 16, seed: int = 3):
        drawn = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        small = 1 / np.sqrt(hidden)
        self.p = {"out": drawn.normal(0, small, (2 * hidden, labels)), "out_b": np.zeros(labels)}
        self.p["trans"] = np.zeros((labels, labels))
        for side in ("f", "b"):
            self.p[f"{side}_in"] = drawn.normal(0, 0.3, (ALPHABET, 4 * hidden))
            self.p[f"{side}_rec"] = drawn.normal(0, small, (hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden : 2 * hidden] = 1.0  # remember at first
            self.p[f"{side}_b"] = bias

    # -- LSTM -------------------------------------------------------------------

    def _run(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """Hidden states ``(length, windows, hidden)`` in text order, and what the way back needs."""
        n, length = x.shape
        h, c = np.zeros((n, self.hidden)), np.zeros((n, self.hidden))
        out, kept = np.empty((length, n, self.hidden)), []
        k = self.hidden
        steps = range(length) if side == "f" else range(length - 1, -1, -1)
        for t in steps:
            gates = self.p[f"{side}_in"][x[:, t]] + h @ self.p[f"{side}_rec"] + self.p[f"{side}_b"]
            i, f, o = (_sigmoid(gates[:, j * k : (j + 1) * k]) for j in range(3))
            g = np.tanh(gates[:, 3 * k :])
            before_h, before_c = h, c
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            out[t] = h
            kept.append((t, i, f, o, g, before_h, before_c, squashed))
        return out, kept

    def _back(self, x: np.ndarray, side: str, kept: list, d_out: np.ndarray, grads: dict) -> None:
        n = len(x)
        dh, dc = np.zeros((n, self.hidden)), np.zeros((n, self.hidden))
        rec = self.p[f"{side}_rec"]
        for t, i, f, o, g, before_h, before_c, squashed in reversed(kept):
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - squashed**2)
            d = np.concatenate(
                [dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], 1
            )
            np.add.at(grads[f"{side}_in"], x[:, t], d)
            grads[f"{side}_rec"] += before_h.T @ d
            grads[f"{side}_b"] += d.sum(0)
            dh, dc = d @ rec.T, dc * f

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """Scores ``(windows, length, labels)`` of each character's labels."""
        both = np.concatenate([self._run(x, "f")[0], self._run(x, "b")[0]], 2)
        return (both @ self.p["out"] + self.p["out_b"]).transpose(1, 0, 2)

    # -- CRF --------------------------------------------------------------------

    def _forward_backward(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log sums from the left and from the right, and the log of the whole."""
        n, length, _ = e.shape
        trans = self.p["trans"]
        left, right = np.empty_like(e), np.zeros_like(e)
        left[:, 0] = e[:, 0]
        for t in range(1, length):
            left[:, t] = e[:, t] + _log_sum(left[:, t - 1][:, :, None] + trans[None], 1)
        for t in range(length - 2, -1, -1):
            right[:, t] = _log_sum(trans[None] + (e[:, t + 1] + right[:, t + 1])[:, None, :], 2)
        return left, right, _log_sum(left[:, -1], 1)

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the labels, and its gradients."""
        n, length = x.shape
        (ahead, kept_f), (back, kept_b) = self._run(x, "f"), self._run(x, "b")
        both = np.concatenate([ahead, back], 2)
        e = (both @ self.p["out"] + self.p["out_b"]).transpose(1, 0, 2)
        left, right, whole = self._forward_backward(e)
        trans = self.p["trans"]
        rows = np.arange(n)
        gold = np.take_along_axis(e, y[:, :, None], 2)[:, :, 0].sum(1) + trans[y[:, :-1], y[:, 1:]].sum(1)
        d_e = np.exp(left + right - whole[:, None, None])
        np.subtract.at(d_e, (rows[:, None], np.arange(length)[None], y), 1.0)
        pairs = left[:, :-1, :, None] + trans + (e[:, 1:] + right[:, 1:])[:, :, None, :]
        d_trans = np.exp(pairs - whole[:, None, None, None]).sum((0, 1))
        np.subtract.at(d_trans, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
        d = d_e.transpose(1, 0, 2) / n
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["trans"] = d_trans / n
        grads["out"] = np.tensordot(both, d, ([0, 1], [0, 1]))
        grads["out_b"] = d.sum((0, 1))
        d_both = d @ self.p["out"].T
        self._back(x, "f", kept_f, d_both[:, :, : self.hidden], grads)
        self._back(x, "b", kept_b, d_both[:, :, self.hidden :], grads)
        return float((whole - gold).mean()), grads

    def decode(self, e: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best labels of each sequence, and the chance of each of those labels.

        ``e`` is padded to the longest; scores beyond a sequence's length are not used.
        """
        n, longest, k = e.shape
        e = e.copy()
        beyond = np.arange(longest)[None] >= lengths[:, None]
        e[beyond] = -1e4
        e[beyond, 0] = 0.0
        trans = self.p["trans"]
        best, back = e[:, 0], np.zeros((n, longest, k), np.int64)
        for t in range(1, longest):
            scores = best[:, :, None] + trans[None]
            back[:, t] = scores.argmax(1)
            best = scores.max(1) + e[:, t]
        path = np.empty((n, longest), np.int64)
        path[:, -1] = best.argmax(1)
        for t in range(longest - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        left, right, whole = self._forward_backward(e)
        chance = np.exp(left + right - whole[:, None, None])
        return path, np.take_along_axis(chance, path[:, :, None], 2)[:, :, 0]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit_tagger(
    x: np.ndarray,
    y: np.ndarray,
    labels: int,
    hidden: int = 16,
    epochs: int = 8,
    batch: int = 64,
    rate: float = 1e-2,
    seed: int = 3,
) -> Tagger:
    """Fit by Adam; the rate falls to a tenth over the run."""
    tagger = Tagger(labels, hidden, seed)
    drawn = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(a) for k, a in tagger.p.items()}
    steps = max(1, epochs * -(-len(x) // batch))
    step = 0
    for _ in range(epochs):
        order = drawn.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at : at + batch]
            _, grads = tagger.loss(x[rows], y[rows])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                tagger.p[k] = tagger.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return tagger
