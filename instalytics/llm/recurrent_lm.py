"""A gated recurrent language model in numpy with a class-factored output.

P(word | state) = P(class | state) * P(word | class[, state]). The ``HEAD``
most frequent words (and the end token) lie in classes of ``WIDE``, with a
softmax over the words of the class; all other words lie in classes by their
last two bytes, where the share of a word is its smoothed corpus count. So
every text, unknown words included, has a proper probability.

Training is truncated backpropagation over windows of ``STEPS`` words, many
texts side by side; the state is carried from window to window and starts at
zero with each text. Scoring carries it through whole texts in the same way.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END = b"\n"  # can be no word
HEAD, WIDE, TAIL = 512, 32, 48
H = 24
STEPS = 16
LANES = 256
WINDOW = 32
ROWS = 2048
TEXTS = 1000


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts (strings, null: empty), A-Z lower-cased, as bytes, and their number in each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, at = parts.flatten(), parts.offsets.to_numpy()
    full = pc.binary_length(words).to_numpy() > 0  # white space at either end leaves an empty one
    if full.all():
        return words.cast(pa.binary()), np.diff(at)
    before = np.r_[0, np.cumsum(full)]
    return words.filter(pa.array(full)).cast(pa.binary()), np.diff(before[at - at[0]])


@dataclass
class Vocabulary:
    """``counts``: the most frequent words with their counts in the training
    texts; ``suffixes``: last two bytes -> (tokens, types) over all of them."""

    counts: dict[bytes, int]
    suffixes: dict[bytes, tuple[int, int]]
    tokens: int
    types: int
    place: dict[bytes, int] = field(init=False)

    def __post_init__(self):
        order = sorted(self.counts, key=lambda w: (-self.counts[w], w))
        head = [END] + [w for w in order if w != END][: HEAD - 1]
        known = set(head)
        rest = [w for w in order if w not in known]
        tail = {s: list(v) for s, v in self.suffixes.items()}
        for w in head:  # the tail classes hold the others
            if self.counts.get(w, 0):
                t = tail[w[-2:]]
                t[0], t[1] = t[0] - self.counts[w], t[1] - 1
        big = sorted(tail, key=lambda s: (-tail[s][0], s))[: TAIL - 1]
        self.classes = HEAD // WIDE + TAIL
        self.tail_class = {s: HEAD // WIDE + i for i, s in enumerate(big)}
        self.other = self.classes - 1
        mass, kinds = np.zeros(self.classes), np.zeros(self.classes)
        for s, (n, v) in tail.items():
            c = self.tail_class.get(s, self.other)
            mass[c] += n
            kinds[c] += v
        self.place = {w: i for i, w in enumerate(head + rest)}
        n = len(self.place)
        self.count = np.array([self.counts.get(w, 0) for w in self.place], np.int64)
        self.cls = np.empty(n, np.int32)
        self.cls[: len(head)] = np.arange(len(head)) // WIDE
        self.cls[len(head) :] = [self.class_of(w) for w in rest]
        self.n_head = len(head)
        for i in range(len(head)):
            mass[i // WIDE] += self.count[i]
        self.log_share = np.zeros(n)  # ln P(word | class) of tail words
        self.tail_total = mass + 0.5 * (kinds + 1)
        t = slice(len(head), n)
        self.log_share[t] = np.log((self.count[t] + 0.5) / self.tail_total[self.cls[t]])
        used = np.zeros(self.classes, bool)
        used[self.cls[: len(head)]] = True
        used[HEAD // WIDE :] = True
        self.class_bias = np.where(used, np.log((mass + 0.5) / (mass.sum() + 0.5 * self.classes)), -1e9).astype(np.float32)
        bias = np.full((HEAD // WIDE) * WIDE, -1e9)
        bias[: len(head)] = np.log(self.count[: len(head)] + 0.5)
        self.word_bias = bias.reshape(-1, WIDE).astype(np.float32)

    def class_of(self, word: bytes) -> int:
        return self.tail_class.get(word[-2:], self.other)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Place (or -1) and class of each word, and the words without a place."""
        get = self.place.get
        at = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        cls = self.cls[at]
        lost = np.flatnonzero(at < 0)
        unknown = [words[i] for i in lost]
        if unknown:
            cls[lost] = [self.class_of(w) for w in unknown]
        return at, cls, unknown

    @cached_property
    def _places(self) -> pa.Array:
        return pa.array(list(self.place), pa.binary())

    @cached_property
    def _suffixes(self) -> pa.Array:
        return pa.array(list(self.tail_class), pa.binary())

    def lookup(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Places (or -1) and classes of all words of the texts, one text after the other and
        each with its end; the number of words of each text (its end included); the words
        without a place, and where those stand."""
        words, counts = words_of(texts)
        at = pc.fill_null(pc.index_in(words, value_set=self._places), -1).to_numpy()
        cls = self.cls[at]
        lost = np.flatnonzero(at < 0)
        unknown = words.take(pa.array(lost))
        ends = pc.index_in(pc.binary_slice(unknown, -2), value_set=self._suffixes)
        cls[lost] = pc.fill_null(pc.add(ends, HEAD // WIDE), self.other).to_numpy()
        # the end has place 0
        stop = np.cumsum(counts)
        return np.insert(at, stop, 0), np.insert(cls, stop, self.cls[0]), counts + 1, unknown, lost + np.searchsorted(stop, lost, "right")

    def encode_texts(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], list[list[bytes]]]:
        """As ``encode`` for the words of each text and the end, all texts at once."""
        at, cls, counts, unknown, lost = self.lookup(texts)
        cuts = np.cumsum(counts)
        parts, unknown = np.searchsorted(lost, np.r_[0, cuts]).tolist(), unknown.to_pylist()
        return np.split(at, cuts[:-1]), np.split(cls, cuts[:-1]), [unknown[a:b] for a, b in zip(parts, parts[1:])]

    def encode_batch(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], list[list[bytes]]]:
        """``encode_texts``, ``TEXTS`` texts at a time."""
        out = ([], [], [])
        for lo in range(0, len(texts), TEXTS):
            for a, b in zip(out, self.encode_texts(texts.slice(lo, TEXTS)), strict=True):
                a += b
        return out

    def inputs(self, at: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Row of the input table: one for each head word, one for each tail class."""
        return np.where((at >= 0) & (at < self.n_head), at, HEAD + cls)


def fresh(v: Vocabulary, seed: int = 3) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    def small(*shape, s=0.1):
        return (g.standard_normal(shape) * s).astype(np.float32)
    return {"E": small(HEAD + v.classes, 3 * H), "U": small(H, 3 * H, s=0.2), "Wc": small(H, v.classes, s=0.05), "bc": v.class_bias.copy(),
            "Wk": small(HEAD // WIDE, H, WIDE, s=0.05), "bk": v.word_bias.copy()}


def lay_out(lengths: list[int], lanes: int) -> list[list[int]]:
    """Texts dealt to lanes, longest first to the least loaded; fullest lane first."""
    heap = [(0, i) for i in range(min(lanes, max(1, len(lengths))))]
    deal: list[list[int]] = [[] for _ in heap]
    load = [0] * len(heap)
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n, i = heapq.heappop(heap)
        deal[i].append(k)
        load[i] = n + lengths[k]
        heapq.heappush(heap, (load[i], i))
    return [deal[i] for i in sorted(range(len(deal)), key=lambda i: -load[i])]


class _Grid:
    """Lanes side by side, cut out window by window from flat arrays."""

    def __init__(self, deal, places, classes, v):
        order = [k for d in deal for k in d]
        self.at = np.concatenate([places[k] for k in order]).astype(np.int32)
        self.cls = np.concatenate([classes[k] for k in order]).astype(np.int32)
        self.x = v.inputs(self.at, self.cls).astype(np.int32)
        lens = [len(places[k]) for k in order]
        self.doc = np.repeat(np.array(order, np.int32), lens)
        self.new = np.zeros(len(self.at), bool)
        self.new[np.cumsum([0] + lens[:-1])] = True
        self.load = np.array([sum(len(places[k]) for k in d) for d in deal])  # fullest first
        self.first = np.cumsum(np.r_[0, self.load[:-1]])
        self.lanes, self.steps = len(deal), int(self.load[0])

    def window(self, lo: int, hi: int):
        """Lanes at work, which of their steps are real, and where those are in the flat arrays."""
        n = int((self.load > lo).sum())
        step = np.arange(lo, hi)[:, None]
        live = step < self.load[None, :n]
        return n, live, np.where(live, self.first[None, :n] + step, 0)


def _states(p, x, new, h):
    """All steps of a window (``x``, ``new``: steps x lanes) from the states ``h``: the
    states each step begins with, its gates, its new state, what the gates take
    from the state, and the states after the window."""
    steps, n = x.shape
    states, new_h = np.empty((steps + 1, n, H), np.float32), np.empty((steps, n, H), np.float32)
    e, hu = p["E"].take(x, 0).reshape(steps, n, 3, H), np.empty((steps, n, 3 * H), np.float32)
    # gate by gate, so that what a step works on lies together
    gates = np.negative(e[:, :, :2].transpose(0, 2, 1, 3), out=np.empty((steps, 2, n, H), np.float32))  # -(e + hu) in the end
    states[0] = h
    one, u, begins = np.float32(1), p["U"], new.any(1).tolist()
    by_gate = hu.reshape(steps, n, 3, H).transpose(0, 2, 1, 3)
    for t, (s, a, b, g, c, ec, after) in enumerate(zip(states, hu, by_gate, gates, new_h, np.ascontiguousarray(e[:, :, 2]), states[1:])):
        if begins[t]:
            s[new[t]] = 0
        np.dot(s, u, out=a)
        np.subtract(g, b[:2], out=g)
        np.exp(g, out=g)
        np.add(g, one, out=g)
        np.reciprocal(g, out=g)
        np.multiply(g[1], b[2], out=c)
        np.add(c, ec, out=c)
        np.tanh(c, out=c)
        np.subtract(s, c, out=after)
        np.multiply(after, g[0], out=after)
        np.add(after, c, out=after)
    return states[:-1], gates[:, 0], gates[:, 1], new_h, by_gate[:, 2], states[-1]


def _step(p, x, h):
    """One step of all lanes: the new state, and what backpropagation needs."""
    _, z, r, n, hun, nxt = _states(p, x[None], np.zeros((1, len(h)), bool), h)
    return nxt, z[0], r[0], n[0], hun[0]


def _softmax(a):
    """In place."""
    a -= a.max(1, keepdims=True)
    np.exp(a, out=a)
    a /= a.sum(1, keepdims=True)
    return a


def _head_rows(k, head):
    """Rows of head words in the order of their class, and where each class begins."""
    order = np.flatnonzero(head)
    order = order[np.argsort(k[order].astype(np.int16), kind="stable")]  # small integers sort by radix
    return order, np.searchsorted(k[order], np.arange(HEAD // WIDE + 1))


def _head_logits(p, s, k, cuts):
    """Logits inside their class of rows in the order of the class."""
    out = np.empty((len(s), WIDE), np.float32)
    for w, b, e in zip(p["Wk"], cuts, cuts[1:]):
        if b < e:
            np.matmul(s[b:e], w, out=out[b:e])
    out += p["bk"].take(k, 0)
    return out


def score(v: Vocabulary, p: dict, places: list[np.ndarray], classes: list[np.ndarray]) -> np.ndarray:
    """ln probability of each text (places and classes of its tokens), but for
    the shares of words without a place, which count as 1."""
    total = np.zeros(len(places))
    if not places:
        return total
    deal = lay_out([len(a) for a in places], LANES)
    grid = _Grid(deal, places, classes, v)
    h = np.zeros((grid.lanes, H), np.float32)
    for lo in range(0, grid.steps, WINDOW):
        hi = min(lo + WINDOW, grid.steps)
        n, live, flat = grid.window(lo, hi)
        x, new = grid.x[flat], grid.new[flat] & live
        states, _, _, _, _, h = _states(p, x, new, h[:n])
        s, flat = states[live], flat[live]
        d, k, a = grid.doc[flat], grid.cls[flat], grid.at[flat]
        ln = np.empty(len(s))
        for i in range(0, len(s), ROWS):  # what stays in the cache
            logits = s[i : i + ROWS] @ p["Wc"]
            logits += p["bc"]
            ln[i : i + ROWS] = logits[np.arange(len(logits)), k[i : i + ROWS]]
            np.exp(logits, out=logits)
            ln[i : i + ROWS] -= np.log(logits @ np.ones(v.classes, np.float32))
        head = (a >= 0) & (a < v.n_head)
        ln += np.where(head | (a < 0), 0.0, v.log_share[a])
        order, cuts = _head_rows(k, head)
        w = _head_logits(p, s[order], k[order], cuts.tolist())
        w -= w.max(1, keepdims=True)
        ln[order] += w[np.arange(len(w)), a[order] % WIDE]
        np.exp(w, out=w)
        ln[order] -= np.log(w @ np.ones(WIDE, np.float32))
        total += np.bincount(d, ln, len(total))
    return total


def _packed(p: dict) -> tuple[dict, np.ndarray]:
    """A copy of the weights in one array, and the views of each."""
    flat = np.concatenate([a.ravel() for a in p.values()])
    ends = np.cumsum([a.size for a in p.values()])
    return {k: flat[end - a.size : end].reshape(a.shape) for (k, a), end in zip(p.items(), ends, strict=True)}, flat


def train(v: Vocabulary, p: dict, places: list[np.ndarray], classes: list[np.ndarray], lanes: int = 64, rate: float = 0.01) -> tuple[dict, int]:
    """One pass over the texts from the weights ``p``; the new weights and the number of tokens."""
    p, flat_p = _packed(p)
    g, flat_g = _packed(p)
    m1, m2, step = np.zeros_like(flat_p), np.zeros_like(flat_p), np.empty_like(flat_p)
    if not places:
        return p, 0
    deal = lay_out([len(a) for a in places], lanes)
    grid = _Grid(deal, places, classes, v)
    h = np.zeros((grid.lanes, H), np.float32)
    for i, lo in enumerate(range(0, grid.steps, STEPS)):
        hi = min(lo + STEPS, grid.steps)
        n, live, flat = grid.window(lo, hi)
        x, new = grid.x[flat], grid.new[flat] & live
        states, z, r, new_h, hun, h = _states(p, x, new, h[:n])
        full = bool(live.all())
        s, flat = (states.reshape(-1, H), flat.ravel()) if full else (states[live], flat[live])
        k, a = grid.cls[flat], grid.at[flat]
        size = np.float32(1 / max(1, len(s)))
        d = s @ p["Wc"]
        d += p["bc"]
        d = _softmax(d)
        d[np.arange(len(s)), k] -= 1
        d *= size
        g["Wc"][:], g["bc"][:] = s.T @ d, d.sum(0)
        ds = d @ p["Wc"].T
        order, cuts = _head_rows(k, (a >= 0) & (a < v.n_head))
        cuts, sh = cuts.tolist(), s[order]
        d = _softmax(_head_logits(p, sh, k[order], cuts))
        d[np.arange(len(order)), a[order] % WIDE] -= 1
        d *= size
        dsh, turned = np.empty_like(sh), sh.T
        g["Wk"][:], g["bk"][:] = 0, 0
        for b, e, w, to_w, to_b in zip(cuts, cuts[1:], p["Wk"], g["Wk"], g["bk"]):
            if b < e:
                part = d[b:e]
                np.matmul(turned[:, b:e], part, out=to_w)
                np.add.reduce(part, 0, out=to_b)
                np.matmul(part, w.T, out=dsh[b:e])
        ds[order] += dsh
        if full:
            out = ds.reshape(hi - lo, n, H)
        else:
            out = np.zeros((hi - lo, n, H), np.float32)
            out[live] = ds
        # the factors of all steps at once; what is left for the steps is the chain of dh
        rest = 1 - z
        to_n = new_h * new_h
        np.subtract(1, to_n, out=to_n)
        to_n *= rest
        to_z = states - new_h
        to_z *= z
        to_z *= rest
        if not full:
            on = live[:, :, None]
            to_n *= on
            to_z *= on
        to_hu = np.empty((hi - lo, 2, n, H), np.float32)
        np.multiply(hun, r, out=to_hu[:, 0])
        to_hu[:, 0] *= 1 - r
        to_hu[:, 1] = r
        dn, dhu = np.empty((hi - lo, n, H), np.float32), np.empty((hi - lo, n, 3 * H), np.float32)
        dh, back, begins = np.zeros((n, H), np.float32), p["U"].T.copy(), new.any(1).tolist()
        more = np.empty_like(dh)
        split = dhu.reshape(hi - lo, n, 3, H).transpose(0, 2, 1, 3)
        for t in range(hi - lo - 1, -1, -1):
            d, du = dn[t], split[t]
            np.multiply(dh, to_z[t], out=du[0])
            np.multiply(dh, to_n[t], out=d)
            np.multiply(d, to_hu[t], out=du[1:])
            np.multiply(dh, z[t], out=dh)
            np.add(dh, np.dot(dhu[t], back, out=more), out=dh)
            np.add(dh, out[t], out=dh)
            if begins[t]:
                dh[new[t]] = 0
        g["U"][:] = states.reshape(-1, H).T @ dhu.reshape(-1, 3 * H)
        split[:, 2] = dn
        # sums by input row: rows in order, then one sum for each run
        order = np.argsort(x.astype(np.int16), axis=None, kind="stable")
        rows = x.ravel()[order]
        runs = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        g["E"][:] = 0
        g["E"][rows[runs]] = np.add.reduceat(dhu.reshape(-1, 3 * H).take(order, 0), runs)
        flat_g *= np.float32(min(1.0, 1.0 / (np.sqrt(float(flat_g @ flat_g)) + 1e-9)))
        m1 *= np.float32(0.9)
        m1 += np.multiply(flat_g, np.float32(0.1), out=step)
        m2 *= np.float32(0.99)
        np.multiply(flat_g, flat_g, out=step)
        step *= np.float32(0.01)
        m2 += step
        np.multiply(m2, np.float32(1 / (1 - 0.99 ** (i + 1))), out=step)
        np.sqrt(step, out=step)
        step += np.float32(1e-6)
        np.divide(m1, step, out=step)
        step *= np.float32(rate / (1 - 0.9 ** (i + 1)))
        flat_p -= step
    return {k: a.copy() for k, a in p.items()}, len(grid.x)
