"""Adaptive context-mixing range coder for token ids, in numpy.

Ids below 65,536 are cut into blocks. Each block starts from the same fresh
model and can be decoded alone; blocks are coded side by side, one lane each,
so that every numpy call works on all of them.

For each id, tables keyed by the last two ids (order 2) and the last one
(order 1) each predict one id, with a confidence. The chance that the order-2
prediction holds is mixed in the logistic domain from three adaptive
estimates, that of its own confidence, that of the order-1 prediction
(confidence, and whether it agrees) and the block's running rate, by weights that learn
online. The order-1 prediction follows. An id that neither predicts is coded
by its order-0 frequencies in the block: the high byte, then the upper half of
the low byte given the high one, then four plain bits. All arithmetic is on
integers.

The coder keeps a range below 2**62 and moves 32-bit words; carries are
resolved when a block is complete.
"""

from __future__ import annotations

import math
import zlib

import numpy as np

BLOCK = 4096
LANES = 1024
BITS = 12
ONE = 1 << BITS
SLOTS = 1 << 10
HI, LO = 256, 16
STEP = 4

_STRETCH = np.array([round(256 * math.log((i + 0.5) / (ONE - i - 0.5))) for i in range(ONE)], np.int64)
_SQUASH = np.array([min(ONE - 2, max(1, round(ONE / (1 + math.exp(-i / 256))))) for i in range(-2304, 2305)], np.int64)


class _Model:
    """State of all lanes; every block starts equal."""

    def __init__(self, lanes: int):
        self.q2 = np.zeros((lanes, SLOTS), np.int32)  # predicted id * 4 + confidence
        self.q1 = np.zeros((lanes, SLOTS), np.int32)
        self.a2 = np.tile(np.array([64, 1024, 2048, 3072], np.int64), (lanes, 1))
        self.a1 = np.full((lanes, 8), 512, np.int64)
        self.a0 = np.full((lanes, 1), 256, np.int64)
        self.b1 = np.tile(np.array([64, 512, 1024, 2048], np.int64), (lanes, 1))
        self.w = np.full((lanes, 3), 22000, np.int64)
        # counts stay far below 2**24, so they and their sums are exact in 32-bit floats
        self.hi1 = np.full((lanes, 16), 16, np.float32)
        self.hi2 = np.ones((lanes * 16, 16), np.float32)
        self.lo = np.ones((lanes * HI, LO), np.float32)
        self.p1 = np.zeros(lanes, np.int64)
        self.p2 = np.zeros(lanes, np.int64)


_UPTO = np.triu(np.ones((16, 16), np.float32))
_ALL = np.ones(16, np.float32)


def _pick(cum: np.ndarray, target: np.ndarray) -> np.ndarray:
    """First of 16 places whose cumulative count is above the target, at most the last."""
    return np.minimum(((cum <= target.astype(np.float32)[:, None]).astype(np.float32) @ _ALL).astype(np.int64), 15)


class _Coder:
    """Ranges of all lanes. Encoding collects words, decoding reads them."""

    def __init__(self, lanes: int, words: np.ndarray | None = None, room: int = 0):
        self.rng = np.full(lanes, (1 << 62) - 1, np.uint64)
        self.pos = np.zeros(lanes, np.int64)
        self.rows = np.arange(lanes)
        self.words = words
        if words is None:
            self.low = np.zeros(lanes, np.uint64)
            self.out = np.zeros((lanes, room), np.int64)
        else:  # the 62 bits from word ``pos`` on
            self.code = (words[:, 0] << np.uint64(30)) | (words[:, 1] >> np.uint64(2))

    def narrow(self, n: int, r: np.ndarray, cum: np.ndarray, freq: np.ndarray, only: np.ndarray | None = None) -> None:
        shift, size = r * cum.astype(np.uint64), r * freq.astype(np.uint64)
        if only is not None:
            shift, size = np.where(only, shift, np.uint64(0)), np.where(only, size, self.rng[:n])
        self.rng[:n] = size
        if self.words is None:
            self.low[:n] += shift
        else:
            self.code[:n] -= shift

    def refill(self, n: int) -> None:
        due = np.flatnonzero(self.rng[:n] < np.uint64(1 << 30))
        if not len(due):
            return
        self.rng[due] <<= np.uint64(32)
        if self.words is None:
            low = self.low[due]
            self.out[due, self.pos[due]] = (low >> np.uint64(30)).astype(np.int64)  # 32 bits and a carry
            self.low[due] = (low & np.uint64((1 << 30) - 1)) << np.uint64(32)
        else:
            p = np.minimum(self.pos[due], self.words.shape[1] - 3)  # damaged words can ask for more than there are
            more = ((self.words[due, p + 1] & np.uint64(3)) << np.uint64(30)) | (self.words[due, p + 2] >> np.uint64(2))
            self.code[due] = (self.code[due] << np.uint64(32)) | more
        self.pos[due] += 1

    def finish(self) -> list[np.ndarray]:
        """The words of each lane, carries resolved."""
        for shift in (30, 0):  # what is left of low: 62 bits, in words of 32 and 30
            value = (self.low >> np.uint64(30)).astype(np.int64) if shift else ((self.low & np.uint64((1 << 30) - 1)) << np.uint64(2)).astype(np.int64)
            self.out[self.rows, self.pos] = value
            self.pos += 1
        for c in range(int(self.pos.max()) - 1, 0, -1):
            self.out[:, c - 1] += self.out[:, c] >> 32
            self.out[:, c] &= 0xFFFFFFFF
        return [self.out[i, : self.pos[i]].astype(np.uint32) for i in range(len(self.pos))]


def _run(lens: np.ndarray, ids: np.ndarray | None, words: np.ndarray | None):
    """Codes lanes sorted by length, longest first. ids (steps x lanes) to
    encode; words (lanes x words) to decode: returns the ids."""
    lanes, steps = len(lens), int(lens[0])
    m = _Model(lanes)
    coder = _Coder(lanes, words, 2 * steps + 4)
    done = np.zeros((steps, lanes), np.int64) if ids is None else None
    encode = ids is not None
    active = lanes - np.searchsorted(np.sort(lens), np.arange(steps), "right")
    u = np.uint64
    for t in range(steps):
        n = int(active[t])
        rows = coder.rows[:n]
        h1 = (m.p1[:n] * 40503 >> 4) & (SLOTS - 1)
        h2 = ((m.p1[:n] * 40503 + m.p2[:n] * 30011) >> 3) & (SLOTS - 1)
        e2, e1 = m.q2[rows, h2], m.q1[rows, h1]
        q2, c2, q1, c1 = e2 >> 2, e2 & 3, e1 >> 2, e1 & 3
        same = q1 == q2
        x1 = c1 + 4 * same
        p2, p1, p0, pb = m.a2[rows, c2], m.a1[rows, x1], m.a0[:n, 0], m.b1[rows, c1]
        s2, s1, s0 = _STRETCH[p2], _STRETCH[p1], _STRETCH[p0]
        w = m.w[:n]
        f2 = _SQUASH[np.clip((w[:, 0] * s2 + w[:, 1] * s1 + w[:, 2] * s0) >> 16, -2304, 2304) + 2304]
        f1 = np.where(same, 0, np.clip(((ONE - f2) * pb) >> BITS, 1, ONE - 1 - f2))
        f1 = np.where(f1 + f2 >= ONE, 0, f1)
        r = coder.rng[:n] >> u(BITS)
        if encode:
            sym = ids[t, :n]
            hit2 = sym == q2
            hit1 = ~hit2 & (sym == q1) & (f1 > 0)
        else:
            code = coder.code[:n]
            edge = r * f2.astype(u)
            hit2 = code < edge
            hit1 = ~hit2 & (code < edge + r * f1.astype(u))
        miss = ~(hit2 | hit1)
        coder.narrow(n, r, np.where(hit2, 0, np.where(hit1, f2, f2 + f1)), np.where(hit2, f2, np.where(hit1, f1, ONE - f2 - f1)))
        # order 0: high byte by two halves, its counts sum to 256 + STEP * t at most
        some = bool(miss.any())
        if some:
            cum1 = m.hi1[:n] @ _UPTO
            total = cum1[:, 15].astype(np.int64)
            r = coder.rng[:n] // total.astype(u)
            if encode:
                hi = sym >> 8
                i = hi >> 4
            else:
                target = np.minimum((coder.code[:n] // r).astype(np.int64), total - 1)
                i = np.where(miss, _pick(cum1, target), 0)
            below = (cum1[rows, i] - m.hi1[rows, i]).astype(np.int64)
            row = m.hi2.take(rows * 16 + i, 0)
            cum2 = row @ _UPTO
            j = (hi & 15) if encode else np.where(miss, _pick(cum2, target - below), 0)
            f = row[rows, j].astype(np.int64)
            coder.narrow(n, r, below + cum2[rows, j].astype(np.int64) - f, f, miss)
            if not encode:
                hi = i * 16 + j
            coder.refill(n)
            row = m.lo.take(rows * HI + hi, 0)
            cum3 = row @ _UPTO
            total = cum3[:, 15].astype(np.int64)
            r = coder.rng[:n] // total.astype(u)
            if encode:
                a = (sym >> 4) & 15
            else:
                target = np.minimum((coder.code[:n] // r).astype(np.int64), total - 1)
                a = np.where(miss, _pick(cum3, target), 0)
            f = row[rows, a].astype(np.int64)
            coder.narrow(n, r, cum3[rows, a].astype(np.int64) - f, f, miss)
            r = coder.rng[:n] >> u(4)
            if encode:
                b = sym & 15
            else:
                b = np.minimum((coder.code[:n] // r).astype(np.int64), 15)
            coder.narrow(n, r, b, np.ones(n, np.int64), miss)
            at, k, g = rows[miss], hi[miss], a[miss]
            m.hi1[at, k >> 4] += STEP
            m.hi2[at * 16 + (k >> 4), k & 15] += STEP
            m.lo[at * HI + k, g] += STEP
        coder.refill(n)
        if not encode:
            sym = np.where(hit2, q2, q1).astype(np.int64)
            if some:
                sym = np.where(miss, (hi << 8) | (a << 4) | b, sym)
            done[t, :n] = sym
        # learning: the estimates, the weights, the predictions
        bit = hit2.astype(np.int64) * (ONE - 1)
        err = bit - f2
        w[:, 0] += (s2 * err) >> 10
        w[:, 1] += (s1 * err) >> 10
        w[:, 2] += (s0 * err) >> 10
        m.a2[rows, c2] = p2 + ((bit - p2) >> 4)
        m.a1[rows, x1] = p1 + ((bit - p1) >> 4)
        m.a0[:n, 0] = p0 + ((bit - p0) >> 5)
        m.b1[rows, c1] = np.where(hit2 | same, pb, pb + ((hit1 * (ONE - 1) - pb) >> 4))
        for tab, h, q, c in ((m.q2, h2, q2, c2), (m.q1, h1, q1, c1)):
            ok = sym == q
            tab[rows, h] = np.where(ok, q * 4 + np.minimum(c + 1, 3), np.where(c > 1, q * 4 + c - 2, sym * 4 + 1))
        m.p2[:n], m.p1[:n] = m.p1[:n], sym
    return coder.finish() if encode else done


def encode(ids: np.ndarray, block: int = BLOCK, lanes: int = LANES) -> list[tuple[int, int, bytes]]:
    """Blocks of the ids: (tokens, crc32 of the ids as little-endian 32-bit, payload)."""
    cuts = list(range(0, len(ids), block))
    parts = [ids[c : c + block].astype(np.int64) for c in cuts]
    out = []
    for lo in range(0, len(parts), lanes):
        some = parts[lo : lo + lanes]
        lens = np.array([len(x) for x in some])  # only the last can be shorter
        grid = np.zeros((lens[0], len(some)), np.int64)
        for k, x in enumerate(some):
            grid[: len(x), k] = x
        for x, w in zip(some, _run(lens, grid, None), strict=True):
            out.append((len(x), zlib.crc32(x.astype("<u4").tobytes()), w.astype("<u4").tobytes()))
    return out


def decode(blocks: list[tuple[int, int, bytes]], lanes: int = LANES) -> np.ndarray:
    """The ids of the blocks; raises ValueError where a checksum fails."""
    out = []
    for lo in range(0, len(blocks), lanes):
        some = blocks[lo : lo + lanes]
        lens = np.array([b[0] for b in some])
        order = np.argsort(-lens, kind="stable")
        raw = [np.frombuffer(some[i][2], "<u4") for i in order]
        words = np.zeros((len(some), max(len(w) for w in raw) + 4), np.uint64)
        for k, w in enumerate(raw):
            words[k, : len(w)] = w
        grid = _run(lens[order], None, words)
        ids = [None] * len(some)
        for k, i in enumerate(order):
            x = grid[: lens[i], k].astype(np.uint32)
            if zlib.crc32(x.astype("<u4").tobytes()) != some[i][1]:
                raise ValueError(f"block {lo + i}: checksum does not match")
            ids[i] = x
        out += ids
    return np.concatenate(out) if out else np.zeros(0, np.uint32)
