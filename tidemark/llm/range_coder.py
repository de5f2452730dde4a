"""Adaptive context-mixing range coder for token ids.

A block of ``BLOCK`` ids is coded on its own, from a fresh model, and carries
its length and the checksums of its ids and of its words. Three predictions
are mixed for every id, with shares that each block learns as it goes:

- order 2: the id that last followed the two ids before (by their hash);
- order 1: the id that last followed the id before;
- order 0: all ids of the block so far, each in proportion to its count.

A prediction that was right several times running counts for more: for each
pair of runs of order 2 and order 1 (``_RUNS`` and more are one) the block
keeps how often either, order 0 or none of them held the id, and codes by
these counts which one does. An id of order 0 is then coded by its share, an
id that the block has not had yet by its number (an escape).

A block is cut into lanes of ``LANE`` ids, which are coded in step, each by a
range coder of its own, and share the block's model: what one lane has learnt
serves all. The model learns after every ``_LEARN`` steps, its table of counts
is taken anew at the steps ``_COUNTED``. Many blocks are worked at together as
numpy arrays, ``BATCH`` at once; encoder and decoder make the same integer
steps, and no block depends on the others of its batch.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 16
LANE = 512
BATCH = 16
#: Ids that are worked at together.
LANES = BATCH
_LEARN = 4
_COUNTED = (1, 4, 12, 28, 64, 128, 240)
_RUNS = 5
_STATES = (_RUNS + 1) ** 2
_SLOT_BITS = 15
_SLOTS = 1 << _SLOT_BITS
_TOTAL = 16  # bits of the total
_T = 1 << _TOTAL
_PRIOR = np.array([2, 2, 4, 2], np.int64)  # order 2, order 1, order 0, escape
_MAGIC = b"TKB2"
_HEAD = struct.Struct("<4sIIIII")  # magic, vocabulary, ids, words, checksum of the ids, of the words
_MASK32 = (1 << 32) - 1
_ID_BITS = 28  # of a slot: the id + 1, above it its run
_ID = np.uint32((1 << _ID_BITS) - 1)
_LOW, _HIGH = np.uint64(_MASK32), np.uint64(32)  # of a share: its start and its size
_FOUR, _ALL = np.uint64(4), np.uint64((1 << 64) - 1)


class _Models:
    """The models of some blocks; ``blk`` tells the block of each lane."""

    def __init__(self, blk: np.ndarray, n: int, vocab: int):
        self.blk, self.n, self.vocab = blk, n, vocab
        self.row = (blk * _SLOTS).astype(np.int64)
        if vocab >= 1 << _ID_BITS:
            raise ValueError("the vocabulary is too large")
        self.table = [np.zeros(n * _SLOTS, np.uint32) for _ in range(2)]  # the id + 1 (0: none) and its run
        self.seen = np.zeros((n, _STATES, 4), np.int64)
        self.seen += _PRIOR
        self.state0 = blk * _STATES
        self.counts = np.zeros(n * vocab, np.int32)
        self.counted = False
        # each id's share (0: none yet); behind the blocks' that of the first digit of an escape
        self.order0 = np.zeros((n + 1) * vocab, np.uint64)
        self.first, wide = (0, _T // vocab) if vocab <= _T else (12, _T // (-(-vocab >> 12)))
        self.digits = [(0, _T >> 12)] if self.first else []  # the others, if any
        digit = np.arange(-(-vocab >> self.first), dtype=np.uint64)
        self.order0[n * vocab:][:len(digit)] = digit * np.uint64(wide) | np.uint64(wide) << _HIGH
        self.wide, self.holder = wide, np.zeros(0, np.int32)
        self.shares()

    def hold(self) -> None:
        """What a decoder needs besides: the id, or the first digit of an
        escape, at each place."""
        self.holder = np.zeros((self.n + 1) << _TOTAL, np.int32)
        self.holder[self.n << _TOTAL:] = np.minimum(np.arange(_T) // self.wide, (self.vocab - 1) >> self.first)

    def shares(self) -> None:
        """The four outcomes' shares in each state. None is empty."""
        total = self.seen.sum(axis=2, keepdims=True)
        size = 1 + self.seen * (_T - 8) // total
        ends = np.cumsum(size, axis=2).reshape(-1, 4)
        ends[:, 3] = _T
        self.ends = [np.ascontiguousarray(ends[:, k], np.int32) for k in range(3)]
        size = np.diff(ends, axis=1, prepend=0).astype(np.uint64)
        self.outcome = (ends.astype(np.uint64) - size | size << _HIGH).reshape(-1)

    def count(self, blk: np.ndarray, ids: np.ndarray) -> None:
        """Take the table of order 0 anew, with these ids besides."""
        flat, more = np.unique(blk * self.vocab + ids, return_counts=True)
        self.counts[flat] += more
        at = np.flatnonzero(self.counts)  # the ids so far, by block
        counts, of = self.counts[at], at // self.vocab
        total, kinds = np.bincount(of, counts, self.n), np.bincount(of, minlength=self.n)
        size = 1 + (counts * ((_T - kinds) / np.maximum(total, 1))[of]).astype(np.int32)
        ends = np.cumsum(size)
        filled = np.bincount(of, size, self.n).astype(np.int64)
        before = np.cumsum(filled) - filled
        self.order0[at] = (ends - size - before[of]).astype(np.uint64) | size.astype(np.uint64) << _HIGH
        if len(self.holder):
            held = np.repeat((at - of * self.vocab).astype(np.int32), size)
            for b, (i, n) in enumerate(zip(before.tolist(), filled.tolist())):
                self.holder[b << _TOTAL:(b << _TOTAL) + n] = held[i:i + n]  # a place beyond the last share is never coded
        self.counted = True

    def look(self, k: int, p1: np.ndarray, p2: np.ndarray):
        """For the first ``k`` lanes (in the last axis) after ids ``p1`` and
        ``p2`` (each + 1): slots, what they hold, candidates and the state."""
        h = p1 * np.uint32(0x9E3779B1)
        one = self.row[:k] + (h >> np.uint32(32 - _SLOT_BITS))
        h ^= h >> np.uint32(15)
        h += p2 * np.uint32(0x85EBCA77)
        h ^= h >> np.uint32(16)
        h *= np.uint32(0xC2B2AE35)
        two = self.row[:k] + (h >> np.uint32(32 - _SLOT_BITS))
        s2, s1 = self.table[0].take(two), self.table[1].take(one)
        c2, c1 = s2 & _ID, s1 & _ID
        r2 = s2 >> np.uint32(_ID_BITS)
        r1 = (s1 >> np.uint32(_ID_BITS)) * (c1 != c2)
        return two, one, s2, s1, c2, c1, r2, r1, self.state0[:k] + (r2 * np.uint32(_RUNS + 1) + r1)

    def learn(self, x: np.ndarray, two, one, s2, s1, state, kind) -> None:
        """Learn what followed in some steps, all in the order of the steps
        and lanes: of several in one slot the last stays."""
        self.seen.reshape(-1)[:] += np.bincount(state * 4 + kind, minlength=self.seen.size)
        self.shares()
        for table, slot, held in ((self.table[0], two, s2), (self.table[1], one, s1)):
            run = np.minimum(held >> np.uint32(_ID_BITS), np.uint32(_RUNS - 1)) * (held & _ID == x)
            table[slot] = x | (run + np.uint32(1)) << np.uint32(_ID_BITS)


def _laid_out(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lanes of blocks of these sizes, by falling length: block, number of
    the lane in its block, and length."""
    lanes = [(b, k, min(LANE, n - k * LANE)) for b, n in enumerate(sizes) for k in range(-(-n // LANE))]
    out = np.array(lanes, np.int64).reshape(-1, 3)
    return tuple(out[np.argsort(-out[:, 2], kind="stable")].T)


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """The steps between which the model learns or counts."""
    last = int(sizes.max(initial=0))
    stops = sorted({*range(0, last, _LEARN), *(c for c in _COUNTED if c < last), last})
    return zip(stops, stops[1:])


def _encode_batch(blocks: list[np.ndarray], vocab: int) -> list[bytes]:
    blk, lane, sizes = _laid_out([len(b) for b in blocks])
    n, steps = len(blk), int(sizes.max(initial=0))
    ids = np.zeros((n, steps), np.uint32)
    for i in range(n):
        ids[i, :sizes[i]] = blocks[blk[i]][lane[i] * LANE:lane[i] * LANE + sizes[i]]
    m = _Models(blk, len(blocks), vocab)
    x = np.zeros((steps + 2, n), np.uint32)  # two rows of none, then the ids + 1 by step
    x[2:] = ids.T
    x[2:] += 1
    del ids
    alive = np.searchsorted(-sizes, -np.arange(steps), "left")  # lanes that have a step
    low, span = np.zeros(n, np.uint64), np.full(n, (1 << 48) - 1, np.uint64)
    words = np.zeros((n, 4 * steps + 4), np.uint32)
    width = words.shape[1]
    flat, put = words.reshape(-1), np.arange(n) * width
    block0, escape0 = blk * vocab - 1, np.int64(len(blocks) * vocab)

    def code(at, start, size):
        """One step for the lanes ``at`` (a slice or indices)."""
        r = span[at] >> np.uint64(_TOTAL)
        lo = low[at] + r * start
        sp = r * size
        small = (sp <= _LOW).astype(np.uint64)
        to = put[at]
        flat[to] = lo >> _HIGH  # stays only if the place moves on
        put[at] = to + small.view(np.int64)
        small <<= _FOUR  # 16 bits move out
        lo <<= small
        lo &= _ALL >> small
        low[at] = lo
        sp <<= small
        span[at] = sp

    counted = 0
    for t, until in _spans(sizes):
        k = int(alive[t])
        if t in _COUNTED:
            there = np.arange(counted, t)[:, None] < sizes[None, :]
            which = np.broadcast_to(blk, there.shape)[there]
            m.count(which, x[2 + counted:2 + t][there].astype(np.int64) - 1)
            counted = t
        now = x[2 + t:2 + until, :k]
        two, one, s2, s1, c2, c1, r2, r1, state = m.look(k, x[1 + t:1 + until, :k], x[t:until, :k])
        kind = np.full(now.shape, 3, np.int64)
        if m.counted:
            own = block0[:k] + now
            own[now == 0] = 0  # past the lane's end
            kind -= m.order0.take(own) != 0
        kind[(now == c1) & (r1 > 0)] = 1
        kind[(now == c2) & (r2 > 0)] = 0
        share = m.outcome.take(state * 4 + kind)
        start, size = share & _LOW, share >> _HIGH
        escaped = kind == 3
        own = np.where(escaped, escape0 + (now - np.uint32(1) >> np.uint32(m.first)), block0[:k] + now)
        own[now == 0] = 0
        share = m.order0.take(own)
        start0, size0 = share & _LOW, share >> _HIGH
        second = kind > 1
        for s in range(until - t):
            k = int(alive[t + s])
            code(slice(0, k), start[s, :k], size[s, :k])
            of = np.flatnonzero(second[s, :k])
            if len(of):
                code(of, start0[s].take(of), size0[s].take(of))
            if m.digits:
                of = np.flatnonzero(escaped[s, :k])
                y = now[s, of].astype(np.uint64) - np.uint64(1)
                for shift, wide in m.digits:
                    y &= np.uint64((1 << m.first) - 1)
                    code(of, (y >> np.uint64(shift)) * np.uint64(wide), np.uint64(wide))
        learnt = now, two, one, s2, s1, state, kind
        if alive[until - 1] == now.shape[1]:
            m.learn(*(a.reshape(-1) for a in learnt))
        else:
            there = np.arange(now.shape[1])[None, :] < alive[t:until, None]
            m.learn(*(a[there] for a in learnt))
    for shift in (32, 16, 0):
        flat[put] = low >> np.uint64(shift) if shift == 32 else low >> np.uint64(shift) & np.uint64(0xFFFF)
        put += 1
    used = put - np.arange(n) * width
    words = words[:, :int(used.max(initial=0))]  # the rest was never touched
    for c in range(words.shape[1] - 1, 0, -1):  # what ran over goes to the word before
        words[:, c - 1] += words[:, c] >> 16
    words &= 0xFFFF
    done = []
    place = np.full((len(blocks), int(lane.max(initial=-1)) + 1), -1)
    place[blk, lane] = np.arange(n)
    for b, block in enumerate(blocks):
        mine = place[b][place[b] >= 0]
        body = used[mine].astype(">u2").tobytes() + b"".join(words[i, :used[i]].astype(">u2").tobytes() for i in mine)
        done.append(_HEAD.pack(_MAGIC, vocab, len(block), len(body) // 2, zlib.crc32(block.astype("<u4").tobytes()), zlib.crc32(body)) + body)
    return done


def encode(ids: np.ndarray, vocab: int) -> list[bytes]:
    """The blocks of a sequence of ids below ``vocab``."""
    if len(ids) and int(ids.max()) >= vocab:
        raise ValueError("an id lies outside the vocabulary")
    blocks = [ids[i:i + BLOCK] for i in range(0, len(ids), BLOCK)]
    return [x for i in range(0, len(blocks), BATCH) for x in _encode_batch(blocks[i:i + BATCH], vocab)]


def split(payload: bytes) -> list[tuple[tuple, memoryview]]:
    """The heads and bodies of the blocks in ``payload``."""
    out, at, view = [], 0, memoryview(payload)
    while at < len(view):
        if len(view) - at < _HEAD.size:
            raise ValueError("a block is cut short")
        head = _HEAD.unpack_from(view, at)
        at += _HEAD.size
        body = view[at:at + 2 * head[3]]
        at += 2 * head[3]
        if head[0] != _MAGIC or len(body) != 2 * head[3] or zlib.crc32(body) != head[5]:
            raise ValueError("a block is damaged")
        out.append((head, body))
    return out


def _decode_batch(blocks: list[tuple[tuple, memoryview]]) -> list[np.ndarray]:
    vocab = blocks[0][0][1]
    blk, lane, sizes = _laid_out([h[2] for h, _ in blocks])
    n, steps = len(blk), int(sizes.max(initial=0))
    alive = np.searchsorted(-sizes, -np.arange(steps), "left")
    coded, used, begin = [], [], []
    for h, body in blocks:
        lanes = -(-h[2] // LANE)
        got = np.frombuffer(body, ">u2")
        used.append(got[:lanes].astype(np.int64))
        coded.append(got[lanes:])
        begin.append(np.cumsum(used[-1]) - used[-1])
        if used[-1].sum() != len(coded[-1]):
            raise ValueError("a block is damaged")
    width = max([0, *(int(u.max(initial=0)) for u in used)]) + 4
    words = np.zeros((n, width), np.uint64)
    for i, (b, k) in enumerate(zip(blk.tolist(), lane.tolist())):
        words[i, :used[b][k]] = coded[b][begin[b][k]:begin[b][k] + used[b][k]]
    flat, get = words.reshape(-1), np.arange(n) * width
    m = _Models(blk, len(blocks), vocab)
    m.hold()
    span, value = np.full(n, (1 << 48) - 1, np.uint64), np.zeros(n, np.uint64)
    for _ in range(3):
        value = value << np.uint64(16) | flat[get]
        get += 1
    x = np.zeros((steps + 2, n), np.uint32)

    def told(at):
        r = span[at] >> np.uint64(_TOTAL)
        return r, np.minimum(value[at] // r, np.uint64(_T - 1)).astype(np.int32)

    def take(at, r, start, size):
        v = value[at] - r * start
        sp = r * size
        small = (sp <= _LOW).astype(np.uint64)
        of = get[at]
        more = flat.take(of)
        more *= small
        get[at] = of + small.view(np.int64)
        small <<= _FOUR  # 16 bits come in
        v <<= small
        v |= more
        value[at] = v
        sp <<= small
        span[at] = sp

    counted = 0
    for t, until in _spans(sizes):
        if t in _COUNTED:
            there = np.arange(counted, t)[:, None] < sizes[None, :]
            m.count(np.broadcast_to(blk, there.shape)[there], x[2 + counted:2 + t][there].astype(np.int64) - 1)
            counted = t
        learnt = []
        for s in range(t, until):
            k = int(alive[s])
            here = slice(0, k)
            two, one, s2, s1, c2, c1, _, _, state = m.look(k, x[1 + s, :k], x[s, :k])
            r, v = told(here)
            kind = sum((v >= ends.take(state)).view(np.int8) for ends in m.ends)
            share = m.outcome.take(state * 4 + kind)
            take(here, r, share & _LOW, share >> _HIGH)
            now = np.where(kind == 0, c2, c1)
            of = np.flatnonzero(kind > 1)
            if len(of):
                escaped = kind.take(of) == 3
                if not m.counted and not escaped.all():
                    raise ValueError("a block is damaged")
                r, v = told(of)
                block = np.where(escaped, m.n, blk.take(of))
                got = m.holder.take((block << _TOTAL) + v)
                share = m.order0.take(block * vocab + got)
                take(of, r, share & _LOW, share >> _HIGH)
                if m.digits:
                    at = np.flatnonzero(escaped)
                    y, lanes = got[at] << m.first, of[at]
                    for shift, wide in m.digits:
                        r, v = told(lanes)
                        digit = v // wide
                        take(lanes, r, (digit * wide).astype(np.uint64), np.uint64(wide))
                        y |= digit << shift
                    got[at] = np.minimum(y, vocab - 1)
                now[of] = got + 1
            x[2 + s, :k] = now
            learnt.append((now, two, one, s2, s1, state, kind))
        m.learn(*(np.concatenate(a) for a in zip(*learnt)))
    done = [np.zeros(h[2], np.uint32) for h, _ in blocks]
    for i, (b, k, size) in enumerate(zip(blk.tolist(), lane.tolist(), sizes.tolist())):
        done[b][k * LANE:k * LANE + size] = x[2:2 + size, i]
    for got, (h, _) in zip(done, blocks):
        got -= 1
        if zlib.crc32(got.astype("<u4").tobytes()) != h[4]:
            raise ValueError("the ids of a block fail their checksum")
    return done


def decode(payload: bytes) -> np.ndarray:
    """The ids of the blocks in ``payload``."""
    blocks = split(payload)
    if len({h[1] for h, _ in blocks}) > 1:
        raise ValueError("blocks of different vocabularies")
    parts = [x for i in range(0, len(blocks), BATCH) for x in _decode_batch(blocks[i:i + BATCH])]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
