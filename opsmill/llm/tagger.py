"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Small on purpose: it is fitted on a bounded number of labelled windows and run
inside tasks over windows of fixed length.
"""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN = 12, 24
# Characters are told apart by kind; letters in either case by themselves.
KINDS = "abcdefghijklmnopqrstuvwxyz0@.+-()=\"':_/ \n,;!?#*"
OTHER_LETTER, OTHER, PAD = len(KINDS) + 1, len(KINDS) + 2, 0
N_KINDS = len(KINDS) + 3


def _kind_table() -> np.ndarray:
    table = np.full(0x10000, OTHER_LETTER, np.uint8)
    table[:128] = OTHER
    for i, c in enumerate(KINDS):
        table[ord(c)] = i + 1
    for c in range(26):
        table[65 + c] = table[97 + c]
    table[49:58] = table[48]
    return table


def kinds(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _kind_table()[np.minimum(codes, 0xFFFF)]


def _start(n_tags: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {"E": rng.normal(0, 0.3, (N_KINDS, EMBED)), "T": np.zeros((n_tags, n_tags)), "o": np.zeros(n_tags),
         "O": rng.normal(0, 0.2, (2 * HIDDEN, n_tags))}
    for d in "fb":
        p["W" + d] = rng.normal(0, 0.25, (EMBED + HIDDEN, 4 * HIDDEN))
        p["c" + d] = np.zeros(4 * HIDDEN)
        p["c" + d][HIDDEN:2 * HIDDEN] = 1.0  # gates begin open to the past
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lstm(x, w, c0, keep=False):
    """States (time, rows, HIDDEN) of one direction over x (time, rows, EMBED)."""
    steps, rows, _ = x.shape
    h, c = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
    ahead = (x.reshape(-1, EMBED) @ w[:EMBED]).reshape(steps, rows, -1) + c0
    out, memo = np.empty((steps, rows, HIDDEN), np.float32), []
    for t in range(steps):
        z = ahead[t] + h @ w[EMBED:]
        gates = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        if keep:
            memo.append((i, f, o, g, before, tc, h))
        h = o * tc
        out[t] = h
    return out, memo


def _lstm_back(dout, x, w, memo):
    steps, rows, _ = x.shape
    dw, dc0, dx = np.zeros_like(w), np.zeros(4 * HIDDEN, np.float32), np.empty_like(x)
    dh, dc = np.zeros((rows, HIDDEN), np.float32), np.zeros((rows, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, h = memo[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dw += np.concatenate([x[t], h], axis=1).T @ dz
        dc0 += dz.sum(axis=0)
        back = dz @ w.T
        dx[t], dh, dc = back[:, :EMBED], back[:, EMBED:], dc * f
    return dx, dw, dc0


def emissions(p, x):
    """Tag scores (rows, time, tags) of windows x (rows, time) of kinds."""
    e = p["E"][x.T]
    forth, _ = _lstm(e, p["Wf"], p["cf"])
    back, _ = _lstm(e[::-1], p["Wb"], p["cb"])
    both = np.concatenate([forth, back[::-1]], axis=2)
    return (both @ p["O"] + p["o"]).transpose(1, 0, 2)


def _logsum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf(s, tags, trans):
    """Negative log likelihood and its gradients; s is (time, rows, tags)."""
    steps, rows, k = s.shape
    a, b = np.empty_like(s), np.zeros_like(s)
    a[0] = s[0]
    for t in range(1, steps):
        a[t] = s[t] + _logsum(a[t - 1][:, :, None] + trans[None], 1)
    for t in range(steps - 2, -1, -1):
        b[t] = _logsum((b[t + 1] + s[t + 1])[:, None, :] + trans[None], 2)
    z = _logsum(a[-1], 1)
    ds, dt = np.exp(a + b - z[None, :, None]), np.zeros_like(trans)
    r = np.arange(rows)
    gold = s[0, r, tags[0]].sum()
    ds[0, r, tags[0]] -= 1
    for t in range(1, steps):
        dt += np.exp(a[t - 1][:, :, None] + trans[None] + (s[t] + b[t])[:, None, :] - z[:, None, None]).sum(axis=0)
        np.subtract.at(dt, (tags[t - 1], tags[t]), 1)
        ds[t, r, tags[t]] -= 1
        gold += s[t, r, tags[t]].sum() + trans[tags[t - 1], tags[t]].sum()
    return float(z.sum() - gold), ds, dt


def _gradients(p, x, tags):
    e = p["E"][x.T]
    forth, mf = _lstm(e, p["Wf"], p["cf"], True)
    back, mb = _lstm(e[::-1], p["Wb"], p["cb"], True)
    both = np.concatenate([forth, back[::-1]], axis=2)
    loss, ds, dt = _crf(both @ p["O"] + p["o"], tags.T, p["T"])
    flat = both.reshape(-1, 2 * HIDDEN)
    g = {"T": dt, "o": ds.sum(axis=(0, 1)), "O": flat.T @ ds.reshape(-1, ds.shape[2])}
    dboth = ds @ p["O"].T
    dxf, g["Wf"], g["cf"] = _lstm_back(dboth[:, :, :HIDDEN], e, p["Wf"], mf)
    dxb, g["Wb"], g["cb"] = _lstm_back(dboth[::-1, :, HIDDEN:], e[::-1], p["Wb"], mb)
    g["E"] = np.zeros_like(p["E"])
    np.add.at(g["E"], x.T, dxf + dxb[::-1])
    return loss, g


def train(x: np.ndarray, tags: np.ndarray, n_tags: int, epochs: int = 8, batch: int = 64, rate: float = 0.03, seed: int = 7):
    """Parameters fitted by Adam on windows x and their tags (rows, time)."""
    p = _start(n_tags, seed)
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    rng, step = np.random.default_rng(seed), 0
    total = epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), batch):
            own = order[k:k + batch]
            _, g = _gradients(p, x[own], tags[own])
            step += 1
            now = rate * (1 - 0.9 * step / total)
            size = np.sqrt(sum(float((w * w).sum()) for w in g.values())) / len(own)
            scale = min(1.0, 5.0 / max(size, 1e-9)) / len(own)
            for name in p:
                d = g[name] * scale
                m[name] = 0.9 * m[name] + 0.1 * d
                v[name] = 0.99 * v[name] + 0.01 * d * d
                p[name] = (p[name] - now * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return p


def allowed(n_tags: int) -> np.ndarray:
    """0 for moves between tags that can be, far below for others: inside a
    kind (even tags) only after its beginning (the odd tag before) or inside."""
    move = np.zeros((n_tags, n_tags), np.float32)
    for t in range(2, n_tags, 2):
        move[:, t] = -1e4
        move[[t - 1, t], t] = 0
    return move


def viterbi(s: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best possible tags for scores s (time, tags)."""
    trans = trans + allowed(s.shape[1])
    s = s.copy()
    s[0, 2::2] = -1e4
    back = np.empty(s.shape, np.int64)
    best = s[0]
    for t in range(1, len(s)):
        ways = best[:, None] + trans
        back[t] = ways.argmax(axis=0)
        best = ways.max(axis=0) + s[t]
    out = np.empty(len(s), np.int64)
    out[-1] = best.argmax()
    for t in range(len(s) - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out
