"""Bidirectional LSTM over characters with a conditional random field on top, in numpy: training and decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: ASCII characters, one code for all others, one for the space after a text's end.
OTHER, PAD = 128, 129
SYMBOLS = 130
NEVER = -1e4


@dataclass(frozen=True)
class Tagger:
    """Parameters: embedding, (input, recurrent, bias) of both directions, output, CRF start and moves."""

    theta: dict[str, np.ndarray]
    tags: int

    @staticmethod
    def fresh(tags: int, width: int = 16, hidden: int = 24, seed: int = 7) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        theta = {"embed": rng.normal(size=(SYMBOLS, width)).astype(np.float32) * np.float32(0.3)}
        for d in "fb":
            theta |= {f"in_{d}": draw(width, 4 * hidden), f"re_{d}": draw(hidden, 4 * hidden)}
            theta[f"bias_{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)
        theta |= {"out": draw(2 * hidden, tags), "bias": np.zeros(tags, np.float32)}
        theta |= {"start": np.zeros(tags, np.float32), "move": np.zeros((tags, tags), np.float32)}
        return Tagger(theta, tags)


def barred(tags: int) -> tuple[np.ndarray, np.ndarray]:
    """Penalties on first tags and moves: tag 0 is outside, odd tags begin a span, the even ones after them continue it."""
    start, move = np.zeros(tags, np.float32), np.zeros((tags, tags), np.float32)
    for inside in range(2, tags, 2):
        start[inside] = NEVER
        move[:, inside] = NEVER
        move[inside - 1, inside] = move[inside, inside] = 0
    return start, move


def coded(texts: list[str], width: int) -> np.ndarray:
    """Symbol codes, one row for each text."""
    out = np.full((len(texts), width), PAD, np.int64)
    for row, t in zip(out, texts):
        codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")
        row[: len(codes)] = np.minimum(codes, OTHER)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lstm(x: np.ndarray, re: np.ndarray) -> tuple[np.ndarray, list]:
    """States over time (axis 0) for gate inputs ``x``; what the backward pass needs."""
    steps, n, four = x.shape
    hidden = four // 4
    h, c = np.zeros((n, hidden), np.float32), np.zeros((n, hidden), np.float32)
    states, kept = np.empty((steps, n, hidden), np.float32), []
    for t in range(steps):
        gates = x[t] + h @ re
        sig = _sigmoid(gates)
        i, f, o = sig[:, :hidden], sig[:, hidden : 2 * hidden], sig[:, 3 * hidden :]
        g = np.tanh(gates[:, 2 * hidden : 3 * hidden])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        kept.append((h, before, i, f, g, o, squashed))
        h = o * squashed
        states[t] = h
    return states, kept


def _lstm_slope(slope: np.ndarray, kept: list, re: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the gate inputs and of the recurrent weights."""
    gates = np.empty((*slope.shape[:2], 4 * slope.shape[2]), np.float32)
    by_re = np.zeros_like(re)
    dh, dc = np.zeros_like(slope[0]), np.zeros_like(slope[0])
    for t in range(len(slope) - 1, -1, -1):
        h, before, i, f, g, o, squashed = kept[t]
        dh = dh + slope[t]
        dc = dc + dh * o * (1 - squashed**2)
        gates[t] = np.concatenate(
            (dc * g * i * (1 - i), dc * before * f * (1 - f), dc * i * (1 - g**2), dh * squashed * o * (1 - o)), axis=1
        )
        by_re += h.T @ gates[t]
        dh, dc = gates[t] @ re.T, dc * f
    return gates, by_re


def _emissions(p: dict, codes: np.ndarray) -> tuple[np.ndarray, tuple]:
    seen = codes.T
    x = p["embed"][seen]
    ahead, kept_f = _lstm(x @ p["in_f"] + p["bias_f"], p["re_f"])
    back, kept_b = _lstm((x @ p["in_b"] + p["bias_b"])[::-1], p["re_b"])
    both = np.concatenate((ahead, back[::-1]), axis=2)
    return both @ p["out"] + p["bias"], (seen, x, kept_f, kept_b, both)


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _forward_backward(e: np.ndarray, start: np.ndarray, move: np.ndarray):
    steps = len(e)
    a, b = np.empty_like(e), np.zeros_like(e)
    a[0] = start + e[0]
    for t in range(1, steps):
        a[t] = _sum_exp(a[t - 1][:, :, None] + move, 1) + e[t]
    for t in range(steps - 2, -1, -1):
        b[t] = _sum_exp(move + (e[t + 1] + b[t + 1])[:, None, :], 2)
    return a, b, _sum_exp(a[-1], 1)


def loss_and_slope(tagger: Tagger, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of tag sequences, and its slope for every parameter."""
    p, k = tagger.theta, tagger.tags
    bar_start, bar_move = barred(k)
    e, (seen, x, kept_f, kept_b, both) = _emissions(p, codes)
    start, move = p["start"] + bar_start, p["move"] + bar_move
    a, b, total = _forward_backward(e, start, move)
    y = tags.T
    steps, n = y.shape
    rows = np.arange(n)
    gold = start[y[0]] + e[0][rows, y[0]]
    slope_move = np.zeros((k, k), np.float32)
    for t in range(1, steps):
        gold = gold + move[y[t - 1], y[t]] + e[t][rows, y[t]]
        pair = a[t - 1][:, :, None] + move + (e[t] + b[t])[:, None, :] - total[:, None, None]
        slope_move += np.exp(pair).sum(axis=0)
        np.subtract.at(slope_move, (y[t - 1], y[t]), 1)
    d = np.exp(a + b - total[:, None])
    out = {"start": d[0].sum(axis=0) - np.bincount(y[0], minlength=k)}
    d[np.arange(steps)[:, None], rows[None, :], y] -= 1
    out |= {"move": slope_move, "out": np.einsum("tnh,tnk->hk", both, d), "bias": d.sum(axis=(0, 1))}
    states = d @ p["out"].T
    hidden = p["re_f"].shape[0]
    gates_f, out["re_f"] = _lstm_slope(states[:, :, :hidden], kept_f, p["re_f"])
    gates_b, out["re_b"] = _lstm_slope(states[::-1, :, hidden:], kept_b, p["re_b"])
    gates_b = gates_b[::-1]
    by_x = gates_f @ p["in_f"].T + gates_b @ p["in_b"].T
    for name, gates in (("f", gates_f), ("b", gates_b)):
        out |= {f"in_{name}": np.einsum("tnd,tng->dg", x, gates), f"bias_{name}": gates.sum(axis=(0, 1))}
    out["embed"] = np.zeros_like(p["embed"])
    np.add.at(out["embed"], seen, by_x)
    return float((total - gold).mean()), {name: (s / n).astype(np.float32) for name, s in out.items()}


def trained(codes: np.ndarray, tags: np.ndarray, kinds: int, steps: int = 200, batch: int = 48, rate: float = 0.01) -> Tagger:
    """Fit by Adam with clipped slopes; batches are drawn by a fixed seed, so a fit can be repeated."""
    tagger = Tagger.fresh(kinds)
    if not len(codes):
        return tagger
    rng = np.random.default_rng(11)
    mean = {n: np.zeros_like(v) for n, v in tagger.theta.items()}
    spread = {n: np.zeros_like(v) for n, v in tagger.theta.items()}
    for i in range(1, steps + 1):
        some = rng.integers(0, len(codes), min(batch, len(codes)))
        _, slope = loss_and_slope(tagger, codes[some], tags[some])
        size = np.sqrt(sum(float((s**2).sum()) for s in slope.values()))
        theta, pace = {}, rate * (1 if i < 0.7 * steps else 0.3)
        for n, v in tagger.theta.items():
            s = slope[n] * min(1.0, 5.0 / (size + 1e-9))
            mean[n] = 0.9 * mean[n] + 0.1 * s
            spread[n] = 0.99 * spread[n] + 0.01 * s**2
            theta[n] = v - np.float32(pace) * (mean[n] / (1 - 0.9**i)) / (np.sqrt(spread[n] / (1 - 0.99**i)) + 1e-8)
        tagger = Tagger(theta, kinds)
    return tagger


def decoded(tagger: Tagger, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tag sequence (Viterbi) of every window, and the marginal probability of each tag on it."""
    bar_start, bar_move = barred(tagger.tags)
    e, _ = _emissions(tagger.theta, codes)
    start, move = tagger.theta["start"] + bar_start, tagger.theta["move"] + bar_move
    steps, n, _ = e.shape
    best, came = start + e[0], np.zeros((steps, n, tagger.tags), np.int64)
    for t in range(1, steps):
        every = best[:, :, None] + move
        came[t] = every.argmax(axis=1)
        best = every.max(axis=1) + e[t]
    path = np.empty((steps, n), np.int64)
    path[-1] = best.argmax(axis=1)
    rows = np.arange(n)
    for t in range(steps - 1, 0, -1):
        path[t - 1] = came[t][rows, path[t]]
    a, b, total = _forward_backward(e, start, move)
    sure = np.exp(a + b - total[:, None])[np.arange(steps)[:, None], rows[None, :], path]
    return path.T, sure.T
