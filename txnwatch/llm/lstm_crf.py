"""A character-level bidirectional LSTM with a CRF on top, forward and backward in numpy.

Batches are (windows, length) arrays of character classes. All parameters are float64 arrays of one dict, so that an
update, a copy to the workers and a gradient check are loops over its items.
"""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN = 8, 12


def init(classes: int, tags: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {"E": rng.normal(0, 0.3, (classes, EMBED)), "O": rng.normal(0, 0.2, (2 * HIDDEN, tags)), "o": np.zeros(tags),
         "A": rng.normal(0, 0.1, (tags, tags)), "s": np.zeros(tags), "e": np.zeros(tags)}
    for d in "fb":
        p[f"W{d}"] = rng.normal(0, 0.3, (EMBED, 4 * HIDDEN))
        p[f"U{d}"] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
        p[f"b{d}"] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]  # open forget gates
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool):
    """Hidden states (n, t, H) of inputs (n, t, EMBED), and what the backward pass needs."""
    n, length, _ = x.shape
    z = x @ w + b
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    out, memory = np.empty((n, length, HIDDEN)), []
    for t in range(length):
        g = z[:, t] + h @ u
        gates = _sigmoid(g[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        a = np.tanh(g[:, 3 * HIDDEN:])
        before, h_before = c, h
        c = f * c + i * a
        tc = np.tanh(c)
        h = o * tc
        out[:, t] = h
        if keep:
            memory.append((i, f, o, a, before, tc, h_before))
    return out, memory


def _lstm_back(x, w, u, memory, d_out):
    d_z = np.empty((*x.shape[:2], 4 * HIDDEN))
    d_u, d_h, d_c = np.zeros_like(u), np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
    for t in range(x.shape[1] - 1, -1, -1):
        i, f, o, a, before, tc, h_before = memory[t]
        d_h = d_h + d_out[:, t]
        d_c = d_c + d_h * o * (1 - tc * tc)
        d_g = np.concatenate([d_c * a * i * (1 - i), d_c * before * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - a * a)], 1)
        d_z[:, t] = d_g
        d_u += h_before.T @ d_g
        d_h, d_c = d_g @ u.T, d_c * f
    flat = d_z.reshape(-1, 4 * HIDDEN)
    return d_z @ w.T, x.reshape(-1, EMBED).T @ flat, d_u, flat.sum(0)


def emissions(p: dict[str, np.ndarray], codes: np.ndarray, keep: bool = False):
    """(n, t, tags) scores of the windows ``codes``; with ``keep`` also the state for ``gradients``."""
    x = p["E"][codes]
    forth, m1 = _lstm(x, p["Wf"], p["Uf"], p["bf"], keep)
    back, m2 = _lstm(x[:, ::-1], p["Wb"], p["Ub"], p["bb"], keep)
    h = np.concatenate([forth, back[:, ::-1]], 2)
    scores = h @ p["O"] + p["o"]
    return (scores, (x, h, m1, m2)) if keep else scores


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def loss(p: dict[str, np.ndarray], codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of the tag sequences, and its gradient."""
    n, length = codes.shape
    scores, (x, h, m1, m2) = emissions(p, codes, keep=True)
    a = p["A"]
    alpha, beta = np.empty_like(scores), np.empty_like(scores)
    alpha[:, 0] = p["s"] + scores[:, 0]
    for t in range(1, length):
        alpha[:, t] = _lse(alpha[:, t - 1, :, None] + a, 1) + scores[:, t]
    beta[:, -1] = p["e"]
    for t in range(length - 2, -1, -1):
        beta[:, t] = _lse(a + (scores[:, t + 1] + beta[:, t + 1])[:, None], 2)
    z = _lse(alpha[:, -1] + p["e"], 1)
    r, at = np.arange(n), np.arange(length)
    gold = scores[r[:, None], at, tags].sum(1) + a[tags[:, :-1], tags[:, 1:]].sum(1) + p["s"][tags[:, 0]] + p["e"][tags[:, -1]]
    g = {k: np.zeros_like(v) for k, v in p.items()}
    unary = np.exp(alpha + beta - z[:, None, None])
    d_s = unary.copy()
    d_s[r[:, None], at, tags] -= 1
    pair = np.exp(alpha[:, :-1, :, None] + a + (scores + beta)[:, 1:, None, :] - z[:, None, None, None]).sum((0, 1))
    np.subtract.at(pair, (tags[:, :-1], tags[:, 1:]), 1)
    g["A"], g["s"], g["e"] = pair, d_s[:, 0].sum(0), d_s[:, -1].sum(0)
    flat = d_s.reshape(-1, d_s.shape[2])
    g["O"], g["o"] = h.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(0)
    d_h = d_s @ p["O"].T
    x1, g["Wf"], g["Uf"], g["bf"] = _lstm_back(x, p["Wf"], p["Uf"], m1, d_h[:, :, :HIDDEN])
    x2, g["Wb"], g["Ub"], g["bb"] = _lstm_back(x[:, ::-1], p["Wb"], p["Ub"], m2, d_h[:, ::-1, HIDDEN:])
    np.add.at(g["E"], codes, x1 + x2[:, ::-1])
    return float((z - gold).mean()), {k: v / n for k, v in g.items()}


def fit(codes: np.ndarray, tags: np.ndarray, n_classes: int, n_tags: int, steps: int, batch: int = 64, rate: float = 0.02,
        seed: int = 11) -> dict[str, np.ndarray]:
    """Adam with a falling rate over random batches of the windows."""
    p, rng = init(n_classes, n_tags), np.random.default_rng(seed)
    m, v = {k: 0.0 for k in p}, {k: 0.0 for k in p}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(codes), min(batch, len(codes)))
        _, g = loss(p, codes[pick], tags[pick])
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        lr = rate * (1 - (step - 1) / steps)
        for k, x in g.items():
            x = x * min(1.0, 5.0 / max(norm, 1e-12))
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.999 * v[k] + 0.001 * x * x
            p[k] = p[k] - lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return p


def viterbi(p: dict[str, np.ndarray], scores: np.ndarray) -> np.ndarray:
    """The best tag sequence for the scores (t, tags) of one stretch of any length."""
    a, best = p["A"], p["s"] + scores[0]
    back = np.zeros(scores.shape, np.int8)
    for t in range(1, len(scores)):
        paths = best[:, None] + a
        back[t] = paths.argmax(0)
        best = paths.max(0) + scores[t]
    out = np.empty(len(scores), np.int64)
    out[-1] = (best + p["e"]).argmax()
    for t in range(len(scores) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


def paths(p: dict[str, np.ndarray], scores: list[np.ndarray], batch: int = 256) -> list[np.ndarray]:
    """``viterbi`` of many stretches, those of similar length side by side; a stretch that has ended keeps its state."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    order, a = sorted(range(len(scores)), key=lambda i: len(scores[i])), p["A"]
    at = 0
    while at < len(order):
        # a stretch much longer than the others goes with its like
        group = [i for i in order[at:at + batch] if len(scores[i]) <= 2 * len(scores[order[at]])]
        at += len(group)
        length, rows = np.array([len(scores[i]) for i in group]), np.arange(len(group))
        if length[-1] == 0:
            continue
        padded = np.zeros((len(group), length[-1], a.shape[0]))
        for k, i in enumerate(group):
            padded[k, :len(scores[i])] = scores[i]
        best = p["s"] + padded[:, 0]
        back = np.zeros(padded.shape, np.int8)
        for t in range(1, length[-1]):
            steps = best[:, :, None] + a
            on = length > t
            back[:, t] = steps.argmax(1)
            best = np.where(on[:, None], steps.max(1) + padded[:, t], best)
        tags = np.zeros((len(group), length[-1]), np.int64)
        tags[rows, length - 1] = (best + p["e"]).argmax(1)
        for t in range(length[-1] - 1, 0, -1):
            before = back[rows, t, tags[:, t]]
            tags[:, t - 1] = np.where(length > t, before, tags[:, t - 1])
        for k, i in enumerate(group):
            out[i] = tags[k, :length[k]]
    return out
