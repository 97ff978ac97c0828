"""An adaptive context-mixing range coder for blocks of token ids, vectorized over lanes.

A block's ids are cut into lanes of ``STEPS`` ids.  All lanes move together, one id a step, and
share one model that starts anew in every block.  An id's probability mixes three predictions:

* order 2: the id expected after the two ids before it, with a confidence;
* order 1: the id expected after the one before it, with a confidence;
* order 0: the counts of all ids of earlier steps, never zero.

The weights of the first two are the odds with which predictions of these confidences came true so
far in the block.  Decoder and encoder update the model alike after each step, so nothing of it is
stored.  Every lane has a carry-less range coder of its own (64-bit state, 32-bit words).

A table of expectations holds id * 8 + confidence, so that one look-up gives both.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

STEPS = 128
LANES = 8192
BLOCK_IDS = STEPS * LANES
_GAIN = 16  # weight of an occurrence against the 1 that every id has
_SURE = 7  # highest confidence
_SLOTS = 1 << 16  # of the order-2 table
_U = np.uint64
_W32, _LOW32, _ONE, _WORD = _U(32), _U(0xFFFFFFFF), _U(1), _U(1 << 32)
#: A quotient of doubles times this is never above the true one, and less by a 2**-50th at most.
_BELOW = 1 - 2.0**-50
#: ids, lanes, words, crc32 of the ids; then crc32 of these four and of what follows.
_HEAD, _CRC = struct.Struct("<IIII"), struct.Struct("<I")

_wrong, _right = [c >> 1 for c in range(8)], [min(c + 1, _SURE) for c in range(8)]
_wrong[0] = _wrong[1] = 1  # then the expected id is replaced as well
_NEXT_SURE = np.array(_wrong + _right, np.int32)  # by right * 8 + confidence


class _Model:
    """Arrays of two rows have what is of order 2 in the first and of order 1 in the second.

    Ids, counts and shares are 32 bits wide: the tables then stay near the processor, and the sum of
    all weights, at most 63 times that of a block's counts, is below 2**31.
    """

    def __init__(self, n_ids: int, lanes: int) -> None:
        self.n = n_ids
        self.count = np.ones(n_ids, np.int32)
        self.cum = np.zeros(n_ids + 1, np.int32)
        self.fresh: list[np.ndarray] = []
        self.table = np.zeros(_SLOTS + n_ids + 1, np.int32)
        self.at = np.zeros((2, lanes), np.int64)  # of the contexts in the table
        self.at[1] = _SLOTS + n_ids
        self.seen = np.zeros((3, 64))  # neither, order 1, order 2 was right; by both confidences
        self.lanes = np.arange(lanes)
        self.step = 0
        self._sum()

    def _sum(self) -> None:
        np.cumsum(self.count, out=self.cum[1:])
        self.total = int(self.cum[-1])

    def _weigh(self) -> None:
        odds = (self.seen[1:] + 0.1) / (self.seen[0] + 0.5)
        weight = np.floor(np.minimum(odds, 31.0) * float(self.total)).astype(np.int32)
        weight[1, :8] = 0
        weight[0, ::8] = 0
        # the second half is for lanes whose two expectations agree: order 2 alone speaks then, if it does
        order2 = np.concatenate([weight[1], weight[1]])
        order1 = np.concatenate([weight[0], np.where(np.arange(64) < 8, weight[0], 0)])
        self.weights, self.sums = (order2, order1), order2 + order1 + self.total

    def predict(self) -> None:
        """Sets the expected ids, their weights, and the sum of all weights for every lane."""
        if self.step < 8 or self.step % 4 == 0:
            self._weigh()
        packed = self.table.take(self.at, mode="wrap")
        self.sure = packed & 7
        self.expected = packed >> 3
        self.ctx = self.sure[0] << 3
        self.ctx |= self.sure[1]
        case = (self.expected[0] == self.expected[1]).astype(np.intp)
        case <<= 6
        case |= self.ctx
        self.weight = [w.take(case, mode="wrap") for w in self.weights]
        self.all = self.sums.take(case, mode="wrap")

    def compare(self, x: np.ndarray) -> None:
        self.x, self.right = x, self.expected == x

    def interval(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the compared ids' shares of ``all``."""
        x = self.x
        first = self.cum.take(x, mode="wrap")
        size = self.count.take(x, mode="wrap")
        before = self.expected < x
        for k in (0, 1):
            first += self.weight[k] * before[k]
            size += self.weight[k] * self.right[k]
        return first.astype(_U), size.astype(_U)

    def find(self, value: np.ndarray, x: np.ndarray) -> None:
        """Puts into ``x`` the ids whose shares hold ``value``: an expected id, or else a search of the counts."""
        begin, end = self.cum.take(self.expected, mode="wrap"), self.count.take(self.expected, mode="wrap")
        a, b = self.expected
        wa, wb = self.weight
        begin[0] += wb * (b < a)
        begin[1] += wa * (a < b)
        end += begin
        end[0] += wa
        end[1] += wb
        beyond = value >= end
        inside = value >= begin
        inside &= ~beyond
        # without the extra weights of smaller ids the counts are left; sorted values are found faster,
        # and the lane (of 2**16 at most) goes along
        keyed = (value - wa * beyond[0] - wb * beyond[1]).astype(np.int64)
        keyed <<= 16
        keyed |= self.lanes
        keyed.sort()
        x[keyed & 0xFFFF] = np.searchsorted(self.cum, (keyed >> 16).astype(np.int32), side="right") - 1
        np.copyto(x, b, where=inside[1])
        np.copyto(x, a, where=inside[0])

    def update(self) -> None:
        x, right = self.x, self.right.view(np.int8)
        outcome = right[0] << 1
        outcome |= right[1] & (right[0] ^ 1)
        outcome = outcome.astype(np.intp)
        outcome <<= 6
        outcome += self.ctx
        self.seen += np.bincount(outcome, minlength=192).reshape(3, 64)
        # an expected id stays if it was right or still trusted; its confidence moves
        stays = self.sure > 1
        stays |= self.right
        new = np.where(stays, self.expected, x)
        new <<= 3
        case = (right << 3).astype(np.intp)
        case += self.sure
        new += _NEXT_SURE.take(case, mode="wrap")
        self.table[self.at] = new
        slot, last = self.at
        last -= _SLOTS
        np.multiply(last, 40_503, out=slot)
        slot += x.astype(np.int64) * 2_654_435
        slot >>= 3
        slot &= _SLOTS - 1
        np.add(x, _SLOTS, out=last)
        self.fresh.append(x)
        self.step += 1
        if self.step in (1, 2, 4) or self.step % 8 == 0:
            self.count += np.bincount(np.concatenate(self.fresh), minlength=self.n).astype(np.int32) * _GAIN
            self.fresh = []
            self._sum()


def _unit(width: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The size of one share: never above ``width // shares``, at least 1 for the widths and shares of a block."""
    unit = width.astype(np.float64)
    unit /= shares
    unit *= _BELOW
    return unit.astype(np.int64).view(_U)


def _settle(low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lanes that give a word away, and the words; moves their state on.

    A range of 2**32 or less that would straddle two words is cut to the first.
    """
    out = np.flatnonzero(width <= _WORD)
    some, size = low[out], width[out]
    np.minimum(size, _WORD - (some & _LOW32), out=size)
    low[out] = some << _W32
    width[out] = ((size - _ONE) << _W32) + _LOW32
    return out, some >> _W32


def encode_block(ids: np.ndarray, n_ids: int) -> bytes:
    n = len(ids)
    if not 0 < n <= BLOCK_IDS:
        raise ValueError("a block has 1 to BLOCK_IDS ids")
    lanes = -(-n // STEPS)
    padded = np.zeros(lanes * STEPS, np.int32)
    padded[:n] = ids
    rows = np.ascontiguousarray(padded.reshape(lanes, STEPS).T)
    model = _Model(n_ids, lanes)
    low, width = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)
    words, used = np.zeros((lanes, STEPS + 2), "<u4"), np.zeros(lanes, np.int64)
    for x in rows:
        model.predict()
        model.compare(x)
        first, size = model.interval()
        unit = _unit(width, model.all)
        low += first * unit
        np.multiply(size, unit, out=width)
        out, given = _settle(low, width)
        words[out, used[out]] = given
        used[out] += 1
        model.update()
    top = (low >> _W32) + _ONE  # one word if it lies in the range with zeros behind it, else two
    short = (low & _LOW32 == 0) | ((low >> _W32 < _LOW32) & ((top << _W32) - low < width))
    every = np.arange(lanes)
    words[every, used] = np.where(low & _LOW32 == 0, low >> _W32, np.where(short, top, low >> _W32))
    used += 1
    long = np.flatnonzero(~short)
    words[long, used[long]] = low[long] & _LOW32
    used[long] += 1
    body = used.astype(np.uint8).tobytes() + words[np.arange(STEPS + 2) < used[:, None]].tobytes()
    head = _HEAD.pack(n, lanes, int(used.sum()), zlib.crc32(np.asarray(ids).astype("<u4").tobytes()))
    return head + _CRC.pack(zlib.crc32(body, zlib.crc32(head))) + body


def decode_block(data: memoryview, n_ids: int) -> tuple[np.ndarray, int]:
    """The ids of the block at the start of ``data`` and the bytes it takes; raises on damage."""
    begin = _HEAD.size + _CRC.size
    if len(data) < begin:
        raise ValueError("damaged block")
    n, lanes, n_words, crc = _HEAD.unpack_from(data)
    end = begin + lanes + 4 * n_words
    body = data[begin:end]
    if len(body) != lanes + 4 * n_words or zlib.crc32(body, zlib.crc32(data[: _HEAD.size])) != _CRC.unpack_from(data, _HEAD.size)[0]:
        raise ValueError("damaged block")
    used = np.frombuffer(body[:lanes], np.uint8).astype(np.int64)
    words = np.zeros((lanes, STEPS + 5), _U)
    words[np.arange(STEPS + 5) < used[:, None]] = np.frombuffer(body[lanes:], "<u4")
    model = _Model(n_ids, lanes)
    low, width = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)
    code, at = (words[:, 0] << _W32) | words[:, 1], np.full(lanes, 2, np.int64)
    out_rows = np.empty((STEPS, lanes), np.int32)
    for t in range(STEPS):
        model.predict()
        unit = _unit(width, model.all)
        x = out_rows[t]
        model.find(_share(code - low, unit.view(np.int64), model.all), x)
        model.compare(x)
        first, size = model.interval()
        low += first * unit
        np.multiply(size, unit, out=width)
        out, _ = _settle(low, width)
        code[out] = (code[out] << _W32) | words[out, at[out]]
        at[out] += 1
        model.update()
    ids = out_rows.T.reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("damaged block")
    return ids, end


def _share(ahead: np.ndarray, unit: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """``ahead // unit``, at most the last share: by doubles, which are off by one at most, and set right."""
    q = (ahead.astype(np.float64) / unit).astype(np.int64)
    rest = ahead.view(np.int64) - q * unit
    q += rest >= unit
    q -= rest < 0
    return np.minimum(q, shares - 1).astype(np.int32)
