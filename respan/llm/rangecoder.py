"""Adaptive range coding of id blocks; many independent blocks are coded side by side with numpy.

Every block starts from the same state and can be read alone.  For each id three predictions are made:
the id last seen after the same two ids, the id last seen after the same one, and the frequencies of all
ids so far, in four 4-bit steps.  Whether the order-2 prediction is right is coded with a probability that
mixes (in the logistic domain, with weights learned on the way) what its own confidence, the order-1
confidence and the block's hit rate say; then whether the order-1 prediction is right; then the id itself.
All arithmetic is on integers, so a block reads the same on every machine.

This is the plain version, for reading blocks without Spark and for tests; columns of blocks are coded by
``TokenIds.java``, which gives the same bytes.
"""

from __future__ import annotations

import numpy as np

BLOCK_IDS = 4096  # ids of a block
LANES = 1024  # blocks coded side by side
ID_LIMIT = 1 << 16
_U = np.uint64
_M32, _TOP, _BOTTOM = _U(0xFFFFFFFF), _U(1 << 24), _U(1 << 16)
_SLOTS = 4096
_ADD, _FULL = 24, 4000

#: squash: 12-bit logistic of x / 256, as integers; stretch: its inverse on 12-bit probabilities.
SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 1, 4095).astype(np.int64)
STRETCH = np.searchsorted(SQUASH, np.arange(4096)).clip(0, 4094) - 2047


class _Coder:
    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, _U), np.full(lanes, _M32)
        self.at = np.zeros(lanes, np.int64)

    def narrow(self, lane, cum, freq, total):
        low, size = self.low[lane], self.range[lane] // total
        low, size = (low + cum * size) & _M32, size * freq
        self.low[lane], self.range[lane] = low, size
        while True:
            same = (low ^ ((low + size) & _M32)) < _TOP
            move = same | (size < _BOTTOM)
            if not move.any():
                return
            lane, low = lane[move], low[move]
            size = np.where(same[move], size[move], (_U(1 << 32) - low) & _U(0xFFFF))
            self.shift(lane, low)
            low, size = (low << _U(8)) & _M32, (size << _U(8)) & _M32
            self.low[lane], self.range[lane] = low, size


class _Writer(_Coder):
    def __init__(self, lanes: int, longest: int):
        super().__init__(lanes)
        self.out = np.zeros((lanes, 4 * longest + 16), np.uint8)

    def shift(self, lane, low):
        self.out[lane, self.at[lane]] = low >> _U(24)
        self.at[lane] += 1

    def flag(self, lane, p, bit):
        q = p.astype(_U)
        self.narrow(lane, np.where(bit, _U(0), q), np.where(bit, q, _U(4096) - q), _U(4096))
        return bit

    def symbol(self, lane, counts, value):
        upto = np.cumsum(counts, axis=1, dtype=_U)
        n = np.arange(len(lane))
        freq = counts[n, value].astype(_U)
        self.narrow(lane, upto[n, value] - freq, freq, upto[:, -1])
        return value

    def done(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for _ in range(4):
            self.shift(every, self.low)
            self.low = (self.low << _U(8)) & _M32
        return [row[:n].tobytes() for row, n in zip(self.out, self.at)]


class _Reader(_Coder):
    def __init__(self, blocks: list[bytes]):
        super().__init__(len(blocks))
        self.data = np.zeros((len(blocks), max(map(len, blocks)) + 8), np.uint8)
        for i, block in enumerate(blocks):
            self.data[i, : len(block)] = np.frombuffer(block, np.uint8)
        self.code = np.zeros(len(blocks), _U)
        every = np.arange(len(blocks))
        for _ in range(4):
            self.shift(every, None)

    def shift(self, lane, low):
        at = np.minimum(self.at[lane], self.data.shape[1] - 1)
        self.code[lane] = ((self.code[lane] << _U(8)) | self.data[lane, at]) & _M32
        self.at[lane] += 1

    def target(self, lane, total):
        return np.minimum(((self.code[lane] - self.low[lane]) & _M32) // (self.range[lane] // total), total - _U(1))

    def flag(self, lane, p, bit):
        q = p.astype(_U)
        bit = self.target(lane, _U(4096)) < q
        self.narrow(lane, np.where(bit, _U(0), q), np.where(bit, q, _U(4096) - q), _U(4096))
        return bit

    def symbol(self, lane, counts, value):
        upto = np.cumsum(counts, axis=1, dtype=_U)
        value = (upto <= self.target(lane, upto[:, -1])[:, None]).sum(axis=1)
        n = np.arange(len(lane))
        freq = counts[n, value].astype(_U)
        self.narrow(lane, upto[n, value] - freq, freq, upto[:, -1])
        return value


class _Model:
    """What has been learned in each block so far."""

    def __init__(self, lanes: int):
        self.after2, self.sure2 = np.zeros((lanes, _SLOTS), np.uint16), np.zeros((lanes, _SLOTS), np.uint8)
        self.after1, self.sure1 = np.zeros((lanes, _SLOTS), np.uint16), np.zeros((lanes, _SLOTS), np.uint8)
        self.hit2 = np.full((lanes, 4), 1024, np.int64)  # 16-bit chance that order 2 is right, by its confidence
        self.hit1 = np.full((lanes, 8), 1024, np.int64)  # the same by order 1's confidence and agreement
        self.hit0 = np.full((lanes, 1), 1024, np.int64)
        self.only1 = np.full((lanes, 4), 1024, np.int64)  # chance that order 1 is right when order 2 is wrong
        self.weight = np.full((lanes, 3), 22000, np.int64)
        self.digits = [np.ones((lanes, n, 16), np.uint16) for n in (1, 16, 256, 256)]


def _learn(table, lane, at, bit):
    p = table[lane, at]
    table[lane, at] = p + ((np.where(bit, 65535, 0) - p) >> 5)


def _run(coder, lengths: np.ndarray, ids: np.ndarray) -> None:
    """Codes column after column of ``ids`` (blocks x places, longest block first); a reader fills it in."""
    m = _Model(len(lengths))
    reading = isinstance(coder, _Reader)
    prev1, prev2 = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for t in range(int(lengths[0]) if len(lengths) else 0):
        n = int(np.searchsorted(-lengths, -t, "left"))
        lane = np.arange(n)
        slot2 = ((prev2[:n] * 40503 + prev1[:n] * 2654435) >> 5) % _SLOTS
        slot1 = (prev1[:n] * 40503 >> 4) % _SLOTS
        guess2, guess1 = m.after2[lane, slot2].astype(np.int64), m.after1[lane, slot1].astype(np.int64)
        sure2, sure1 = m.sure2[lane, slot2], m.sure1[lane, slot1]
        with1 = sure1 + 4 * (guess1 == guess2)
        st = np.stack([STRETCH[m.hit2[lane, sure2] >> 4], STRETCH[m.hit1[lane, with1] >> 4], STRETCH[m.hit0[:n, 0] >> 4]], axis=1)
        p = SQUASH[((st * m.weight[:n]).sum(axis=1) >> 16).clip(-2047, 2047) + 2047]
        value = ids[:n, t]
        is2 = coder.flag(lane, p, None if reading else value == guess2)
        m.weight[:n] = (m.weight[:n] + ((st * (((is2 << 12) - p) * 6)[:, None]) >> 10)).clip(-65536, 131072)
        _learn(m.hit2, lane, sure2, is2)
        _learn(m.hit1, lane, with1, is2)
        _learn(m.hit0, lane, 0, is2)
        found = np.where(is2, guess2, -1)
        ask = np.flatnonzero(~is2 & (guess1 != guess2))
        if len(ask):
            is1 = coder.flag(ask, (m.only1[ask, sure1[ask]] >> 4).clip(1, 4095), None if reading else value[ask] == guess1[ask])
            _learn(m.only1, ask, sure1[ask], is1)
            found[ask] = np.where(is1, guess1[ask], -1)
        rest = np.flatnonzero(found < 0)
        if len(rest):
            known = np.zeros(len(rest), np.int64)
            for k, table in enumerate(m.digits):
                at = known & 255 if k < 3 else (known >> 4) & 255
                counts = table[rest, at]
                digit = coder.symbol(rest, counts, None if reading else (value[rest] >> (12 - 4 * k)) & 15)
                table[rest, at, digit] += _ADD
                full = np.flatnonzero(counts.sum(axis=1, dtype=np.int64) + _ADD > _FULL)
                if len(full):
                    table[rest[full], at[full]] = (table[rest[full], at[full]] >> 1) | 1
                known = (known << 4) | digit
            found[rest] = known
        if reading:
            ids[:n, t] = found
        for after, sure, slot, guess in ((m.after2, m.sure2, slot2, guess2), (m.after1, m.sure1, slot1, guess1)):
            right = found == guess
            held = sure[lane, slot]
            after[lane, slot] = np.where(right | (held > 1), guess, found)
            sure[lane, slot] = np.where(right, np.minimum(held + 1, 3), held >> 1)
        prev2[:n], prev1[:n] = prev1[:n], found


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The coded bytes of each block of ids (at most BLOCK_IDS ids below ID_LIMIT)."""
    out: list[bytes] = [b""] * len(blocks)
    order = sorted((i for i in range(len(blocks)) if len(blocks[i])), key=lambda i: -len(blocks[i]))
    for a in range(0, len(order), LANES):
        part = order[a : a + LANES]
        lengths = np.array([len(blocks[i]) for i in part])
        ids = np.zeros((len(part), lengths[0]), np.int64)
        for row, i in enumerate(part):
            ids[row, : lengths[row]] = blocks[i]
        if ids.min() < 0 or ids.max() >= ID_LIMIT:
            raise ValueError(f"ids must lie in 0 to {ID_LIMIT - 1}")
        coder = _Writer(len(part), int(lengths[0]))
        _run(coder, lengths, ids)
        for i, data in zip(part, coder.done()):
            out[i] = data
    return out


def decode_blocks(coded: list[bytes], lengths: list[int]) -> list[np.ndarray]:
    """The ids of each block, given how many it has."""
    out = [np.zeros(0, np.int64)] * len(coded)
    order = sorted((i for i in range(len(coded)) if lengths[i]), key=lambda i: -lengths[i])
    for a in range(0, len(order), LANES):
        part = order[a : a + LANES]
        size = np.array([lengths[i] for i in part])
        ids = np.zeros((len(part), size[0]), np.int64)
        _run(_Reader([coded[i] for i in part]), size, ids)
        for row, i in enumerate(part):
            out[i] = ids[row, : size[row]]
    return out
