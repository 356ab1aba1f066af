"""A small gated recurrent language model in numpy.

Output: a softmax over classes, then a softmax inside the class (``GROUPS``
groups of ``GROUP_SIZE`` frequent words, the end token among them), or, for the
``SHAPES`` classes of rarer words, the word's smoothed training share of its
class. A word's probability is therefore a full distribution over an open
vocabulary with a fixed number of parameters.

Inputs and outputs are *symbols*: 0 .. FREQUENT-1 frequent words,
FREQUENT .. FREQUENT+SHAPES-1 word shapes, START as the first input only.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 24
GROUPS, GROUP_SIZE = 16, 64
FREQUENT = GROUPS * GROUP_SIZE
END = FREQUENT - 1
SHAPES = 64
START = FREQUENT + SHAPES
CLASSES = GROUPS + SHAPES
#: Steps of one window of truncated backpropagation; the state goes on to the next window.
STEPS = 16

Params = dict[str, np.ndarray]


def initial(frequent_counts: np.ndarray, shape_counts: np.ndarray, seed: int = 7) -> Params:
    """Parameters whose output biases are the log unigram shares, so an untrained
    model equals the class-factored unigram model. ``frequent_counts``: FREQUENT
    counts, -1 for an unused slot."""
    rng = np.random.default_rng(seed)
    used = frequent_counts >= 0
    counts = np.where(used, frequent_counts, 0) + 0.1
    in_group = np.where(used, np.log(counts), -1e9).reshape(GROUPS, GROUP_SIZE)
    group = np.where(used, counts, 0).reshape(GROUPS, GROUP_SIZE).sum(axis=1)
    mass = np.concatenate([group, shape_counts + 0.1])
    draw = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
    return {
        "X": draw(START + 1, 3 * HIDDEN), "U": draw(HIDDEN, 3 * HIDDEN), "u": np.zeros(3 * HIDDEN, np.float32),
        "C": draw(HIDDEN, CLASSES) * 0.1, "c": np.log(np.maximum(mass, 1e-9) / max(mass.sum(), 1e-9)).astype(np.float32),
        "W": draw(GROUPS, HIDDEN, GROUP_SIZE) * 0.1, "w": in_group.astype(np.float32)}


def pack(p: Params) -> bytes:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float32).tobytes()


def unpack(raw: bytes | np.ndarray, like: Params) -> Params:
    flat = np.frombuffer(raw, dtype=np.float32) if isinstance(raw, bytes) else raw
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = flat[at:at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out


class Cell:
    """The recurrent parameters laid out for stepping: gates (z, r) and candidate apart, and the gates'
    factor of one half (a logistic function is a tanh of half its argument) and biases folded in."""

    def __init__(self, p: Params):
        g = 2 * HIDDEN
        self.x_gates, self.x_new = 0.5 * (p["X"][:, :g] + p["u"][:g]), np.ascontiguousarray(p["X"][:, g:])
        self.u_gates, self.u_new, self.b_new = 0.5 * p["U"][:, :g], np.ascontiguousarray(p["U"][:, g:]), p["u"][g:]

    def step(self, sym: np.ndarray, h: np.ndarray):
        """One GRU step: new state, and what the backward pass needs."""
        zr = h @ self.u_gates
        zr += self.x_gates.take(sym, axis=0)
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        m = h @ self.u_new
        m += self.b_new
        n = r * m
        n += self.x_new.take(sym, axis=0)
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, (z, r, n, m)


def step(p: Params, sym: np.ndarray, h: np.ndarray):
    return Cell(p).step(sym, h)


def class_of(sym: np.ndarray) -> np.ndarray:
    return np.where(sym < FREQUENT, sym // GROUP_SIZE, sym - FREQUENT + GROUPS)


#: Rows that go through a softmax at a time: their logits stay in the cache.
ROWS = 512


def _by_group(cls: np.ndarray):
    """(group, rows) of the rows of frequent words, at most ROWS at a time."""
    order = np.argsort(cls.astype(np.int8), kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(GROUPS + 1))
    for g in range(GROUPS):
        for lo in range(int(bounds[g]), int(bounds[g + 1]), ROWS):
            yield g, order[lo:min(lo + ROWS, int(bounds[g + 1]))]


class Output:
    """The output layer: weights with the biases as a last row, for states with a last column of ones.

    States lie within -1 and 1, so the weights bound the logits; only where a bound is too wide for
    exponentials in single precision, rows are shifted by their largest logit."""

    def __init__(self, p: Params):
        self.top = np.concatenate((p["C"], p["c"][None]))
        self.groups = np.concatenate((p["W"], p["w"][:, None]), axis=1)
        self.shift = [self._wide(x) for x in (self.top, *self.groups)]

    @staticmethod
    def _wide(x: np.ndarray) -> bool:
        reach = np.abs(x[:-1]).sum(axis=0)
        return bool((x[-1] + reach).max() > 60 or (x[-1] - reach).max() < -60)

    def exponentials(self, h: np.ndarray, target: np.ndarray, group: int = -1):
        """exp of the logits, their sums and the targets' logits, less the shift."""
        x = h @ (self.top if group < 0 else self.groups[group])
        if self.shift[group + 1]:
            x -= x.max(axis=1, keepdims=True)
        own = x[np.arange(len(x)), target]
        np.exp(x, out=x)
        return x, x @ np.ones(x.shape[1], x.dtype), own


def with_ones(h: np.ndarray) -> np.ndarray:
    out = np.ones((len(h), HIDDEN + 1), h.dtype)
    out[:, :HIDDEN] = h
    return out


def log_probs(p: Params, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log probability of each target symbol from each state."""
    cls, layer, h = class_of(target), Output(p), with_ones(h)
    out = np.empty(len(target), h.dtype)
    for lo in range(0, len(target), ROWS):
        at = slice(lo, lo + ROWS)
        _, total, own = layer.exponentials(h[at], cls[at])
        out[at] = own - np.log(total)
    for g, idx in _by_group(cls):
        _, total, own = layer.exponentials(h.take(idx, axis=0), target[idx] % GROUP_SIZE, g)
        out[idx] += own - np.log(total)
    return out


def score_all(p: Params, texts: list[np.ndarray], batch: int = 512, rows: int = 1 << 14) -> np.ndarray:
    """Log probability of each complete symbol sequence (its end token included).
    Sequences of similar length go side by side; each one's state is carried
    on up to its end, whatever its length. ``rows`` states at a time go through the output layer."""
    out = np.zeros(len(texts))
    cell = Cell(p)
    order = np.argsort([-len(t) for t in texts], kind="stable")
    for lo in range(0, len(order), batch):
        group = order[lo:lo + batch]
        lens = np.array([len(texts[i]) for i in group])
        flat, at = np.concatenate([texts[i] for i in group]).astype(np.int64), np.cumsum(lens) - lens
        live = np.searchsorted(-lens, -np.arange(lens[0]))  # sequences longer than t
        h = np.zeros((len(group), HIDDEN), p["U"].dtype)
        last = np.full(len(group), START, dtype=np.int64)
        total = np.zeros(len(group))
        states, targets, held = [], [], 0
        for t, k in enumerate(live.tolist()):
            h, _ = cell.step(last[:k], h[:k])
            last = flat[at[:k] + t]
            states.append(h)
            targets.append(last)
            held += k
            if held >= rows or t + 1 == len(live):
                lp = log_probs(p, np.concatenate(states), np.concatenate(targets))
                first = 0
                for x in targets:
                    total[:len(x)] += lp[first:first + len(x)]
                    first += len(x)
                states, targets, held = [], [], 0
        out[group] = total
    return out


def gradients(p: Params, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray):
    """Loss sum, gradients and last state over one window; inputs and targets are
    (steps, streams), the state before a START input is reset to zero."""
    states, kept, before = [], [], []
    cell = Cell(p)
    for x in inputs:
        fresh = x == START
        if fresh.any():
            h = np.where(fresh[:, None], h.dtype.type(0), h)
        before.append(h)
        h, k = cell.step(x, h)
        states.append(h)
        kept.append(k)
    flat, y = np.concatenate(states), targets.ravel()
    cls = class_of(y)
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    layer, ones = Output(p), with_ones(flat)
    loss, dh = 0.0, np.empty_like(flat)
    back_top, back_groups = np.ascontiguousarray(p["C"].T), np.ascontiguousarray(p["W"].transpose(0, 2, 1))
    d_top, d_groups = np.zeros_like(layer.top), np.zeros_like(layer.groups)

    def errors(part, target, group=-1):
        """Loss sum and the gradient by the logits."""
        x, total, own = layer.exponentials(part, target, group)
        x *= (1 / total)[:, None]
        x[np.arange(len(x)), target] -= 1
        return (np.log(total) - own).sum(dtype=np.float64), x

    for lo in range(0, len(y), ROWS):
        at = slice(lo, lo + ROWS)
        more, d = errors(ones[at], cls[at])
        loss += more
        d_top += ones[at].T @ d
        dh[at] = d @ back_top
    for g, idx in _by_group(cls):
        part = ones.take(idx, axis=0)
        more, d = errors(part, y[idx] % GROUP_SIZE, g)
        loss += more
        d_groups[g] += part.T @ d
        dh[idx] += d @ back_groups[g]
    grads["C"], grads["c"], grads["W"], grads["w"] = d_top[:-1], d_top[-1], d_groups[:, :-1], d_groups[:, -1]
    dh = dh.reshape(len(inputs), -1, HIDDEN)
    carry = np.zeros_like(h)
    da = np.empty((len(inputs), inputs.shape[1], 3 * HIDDEN), h.dtype)
    back = np.ascontiguousarray(p["U"].T)
    for t in range(len(inputs) - 1, -1, -1):
        (z, r, n, mn), prev = kept[t], before[t]
        g = dh[t] + carry
        dn = n * n
        np.subtract(1, dn, out=dn)
        dn *= g
        keep = 1 - z
        dn *= keep
        dm = np.empty((len(g), 3 * HIDDEN), h.dtype)
        dz, dr, dc = dm[:, :HIDDEN], dm[:, HIDDEN:2 * HIDDEN], dm[:, 2 * HIDDEN:]
        np.subtract(prev, n, out=dz)
        dz *= g
        keep *= z
        dz *= keep
        np.multiply(dn, r, out=dc)
        np.subtract(1, r, out=dr)
        dr *= dc
        dr *= mn
        da[t] = dm
        da[t, :, 2 * HIDDEN:] = dn
        grads["U"] += prev.T @ dm
        grads["u"] += dm.sum(axis=0)
        carry = dm @ back
        g *= z
        carry += g
        fresh = inputs[t] == START
        if fresh.any():
            carry[fresh] = 0
    syms = inputs.ravel().astype(np.int16)
    order = np.argsort(syms, kind="stable")
    used, at = np.unique(syms[order], return_index=True)
    grads["X"][used] = np.add.reduceat(da.reshape(-1, 3 * HIDDEN).take(order, axis=0), at, axis=0)
    return loss, grads, h


class Streams:
    """``width`` endless streams of training texts: each takes the next text when
    its own ends, so a text is read whole, window after window."""

    def __init__(self, texts: list[np.ndarray], width: int):
        self.texts, self.next, self.laps = texts, 0, 0.0
        self.open = [self._take() for _ in range(width)]
        self.at = [0] * width

    def _take(self) -> np.ndarray:
        text = self.texts[self.next % len(self.texts)]
        self.next += 1
        self.laps = self.next / len(self.texts)
        return np.concatenate([[START], text])

    def window(self):
        x = np.empty((STEPS, len(self.open)), dtype=np.int64)
        y = np.empty_like(x)
        for k in range(len(self.open)):
            for t in range(STEPS):
                text, at = self.open[k], self.at[k]
                x[t, k], y[t, k] = text[at], text[at + 1]
                self.at[k] += 1
                if at + 2 >= len(text):
                    self.open[k], self.at[k] = self._take(), 0
        return x, y


def train(p: Params, texts: list[np.ndarray], windows: int, width: int = 64, rate: float = 3e-3) -> Params:
    """``windows`` Adam updates, each over one window of ``width`` streams."""
    if not texts or windows < 1:
        return {k: v.copy() for k, v in p.items()}
    streams = Streams(texts, width)
    return _adam(p, ((*streams.window(), i == 0) for i in range(windows)), windows, rate)


def train_whole(p: Params, texts: list[np.ndarray], width: int = 512, rate: float = 3e-3) -> Params:
    """Adam updates over every symbol of ``texts`` exactly once. The texts lie end to end in
    ``width`` equal streams, the rest in fewer; a text that goes over the end of a stream
    goes on in the next one from an empty state."""
    if not texts:
        return {k: v.copy() for k, v in p.items()}
    y = np.concatenate(texts).astype(np.int64)
    x = np.concatenate(([START], y[:-1]))
    x[np.cumsum([len(t) for t in texts])[:-1]] = START
    blocks, at = [], 0
    while at < len(y):
        left = len(y) - at
        streams, steps = max(1, min(width, left // STEPS)), min(STEPS, left)
        times = left // (streams * steps)
        blocks.append((at, streams, steps, times))
        at += streams * steps * times

    def windows():
        for at, streams, steps, times in blocks:
            cut = slice(at, at + streams * steps * times)
            a, b = x[cut].reshape(streams, -1).T, y[cut].reshape(streams, -1).T
            for t in range(0, steps * times, steps):
                yield a[t:t + steps], b[t:t + steps], t == 0

    return _adam(p, windows(), sum(b[3] for b in blocks), rate)


def _adam(p: Params, windows, count: int, rate: float) -> Params:
    """One update for each of the ``count`` windows (inputs, targets, whether the state starts empty)."""
    p = {k: v.copy() for k, v in p.items()}
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    var = {k: np.zeros_like(v) for k, v in p.items()}
    for i, (x, y, empty) in enumerate(windows, 1):
        if empty:
            h = np.zeros((x.shape[1], HIDDEN), np.float32)
        _, grads, h = gradients(p, x, y, h)
        now = rate * min(1.0, i / 20) * (1 - 0.9 * i / count)
        for k, g in grads.items():
            g = np.clip(g / x.size, -0.05, 0.05)
            mean[k] += 0.1 * (g - mean[k])
            var[k] += 0.01 * (g * g - var[k])
            p[k] -= now * (mean[k] / (1 - 0.9 ** i)) / (np.sqrt(var[k] / (1 - 0.99 ** i)) + 1e-6)
    return p
