"""Adaptive coding of token ids: predictions of order 2, 1 and 0 are mixed and drive a range coder.

Blocks of :data:`BLOCK` ids are coded side by side, one numpy lane each, and share nothing. The probability of
an id in its block is ``w * [id is the predicted one] + (1 - w) * P0(id)``:

* The prediction is the id that last followed the same two ids in the block, or else the same id. ``w`` is
  learned for each way the two orders agree.
* ``P0`` counts classes of neighbouring ids; within a class ids are equally likely.

All statistics are integers and are brought up to date every :data:`TURN` ids from what both sides know by then,
so any machine decodes what any other wrote.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Ids of a block, and ids between two updates of its statistics.
BLOCK, TURN = 2048, 128
#: Blocks coded together at most: more lanes are faster, fewer take less memory.
ENCODE_LANES, DECODE_LANES = 2048, 4096
#: log2 of the slots of the order-1 and order-2 memories of a block.
SLOT_BITS = 11
#: Bits of a prediction's weight and of the class frequencies.
WEIGHT_BITS, CLASS_BITS = 10, 12
_MOST = 1000
#: Ways the orders agree: neither knows, order 1 only, order 2 only, both but not the same, the same.
_STATES = 5
_U = np.uint64
_LOW31, _LEAST = _U(2**31 - 1), _U(2**31)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """First id and log2 of the size of each class: eight each of 16, 32, ... ids, then of 512."""
    first, logs, at = [], [], 0
    while at < 1 << 16:
        log = min(9, 4 + len(first) // 8)
        first.append(at)
        logs.append(log)
        at += 1 << log
    return np.array(first), np.array(logs)


FIRST, LOGS = _classes()
CLASS_OF = np.repeat(np.arange(len(FIRST)), np.minimum(1 << LOGS, (1 << 16) - FIRST)).astype(np.int64)
#: Low ids were merged first, so they are likelier from the start.
_PRIOR = (1 + (256 << LOGS) // (FIRST + 256)).astype(np.int32)
#: An entry of the class tables holds the frequency, the sum of those before and the log of the size, from its low bits on.
_CUM_AT, _LOG_AT = CLASS_BITS + 1, 2 * CLASS_BITS + 1
_FREQ, _CUM = (1 << _CUM_AT) - 1, (1 << CLASS_BITS) - 1


class _Model:
    """The statistics of all lanes."""

    def __init__(self, lanes: int):
        self.lanes, self.row = lanes, np.arange(lanes)
        self.slots = self.row << SLOT_BITS
        self.after1 = np.zeros(lanes << SLOT_BITS, np.uint16)
        self.after2 = np.zeros(lanes << SLOT_BITS, np.uint16)
        self.counts = np.repeat(_PRIOR[None], lanes, 0)
        self.hits = np.tile(np.array([0, 1, 2, 2, 3], np.int64), (lanes, 1))
        self.seen = np.tile(np.array([1, 8, 4, 4, 4], np.int64), (lanes, 1))
        self._tables()

    def _tables(self) -> None:
        n = self.counts.shape[1]
        room = (1 << CLASS_BITS) - n
        freq = 1 + self.counts * np.int32(room) // self.counts.sum(axis=1, keepdims=True, dtype=np.int32)
        freq[self.row, self.counts.argmax(axis=1)] += (1 << CLASS_BITS) - freq.sum(axis=1, dtype=np.int32)
        cum = np.cumsum(freq, axis=1, dtype=np.int32) - freq
        self.entries = (freq | cum << _CUM_AT | LOGS.astype(np.int32) << _LOG_AT).reshape(-1)
        self.flat_freq, self.n_classes = freq.reshape(-1), n
        weight = np.minimum((self.hits << WEIGHT_BITS) // self.seen, _MOST)
        weight[:, 0] = 0
        self.weight = weight.astype(_U).reshape(-1)

    def inverse(self) -> np.ndarray:
        return np.repeat(np.tile(np.arange(self.n_classes, dtype=np.uint8), self.lanes), self.flat_freq)

    def contexts(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the memories for the last id ``one`` and the id before it, ``two``, of 32 bits each."""
        mask, h = np.uint32((1 << SLOT_BITS) - 1), one * np.uint32(40503)
        return self.slots + (h >> np.uint32(3) & mask), self.slots + ((h ^ two * np.uint32(60493)) >> np.uint32(4) & mask)

    def predict(self, c1: np.ndarray, c2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The predicted id plus one (0: none), and how the orders agree."""
        p1, p2 = self.after1[c1], self.after2[c2]
        first, second = (p1 > 0).view(np.uint8), (p2 > 0).view(np.uint8)
        state = first + second + second + (first & (p1 == p2).view(np.uint8))
        return np.where(second.view(bool), p2, p1), state

    def update(self, ids: np.ndarray, c1: np.ndarray, c2: np.ndarray, state: np.ndarray, hit: np.ndarray) -> None:
        """Learn from one turn: arrays of (time, lane). Of repeated contexts the last in time stays."""
        after = (ids + 1).astype(np.uint16).reshape(-1)
        self.after1[c1.reshape(-1)] = after
        self.after2[c2.reshape(-1)] = after
        where = (self.row * self.n_classes + CLASS_OF[ids]).reshape(-1)
        self.counts += (24 * np.bincount(where, minlength=self.counts.size)).astype(np.int32).reshape(self.counts.shape)
        where = (self.row * _STATES + state).reshape(-1)
        self.seen += np.bincount(where, minlength=self.seen.size).reshape(self.seen.shape)
        self.hits += np.bincount(where[hit.reshape(-1)], minlength=self.seen.size).reshape(self.seen.shape)
        self._tables()


def _renew(low: np.ndarray) -> np.ndarray:
    return (low & _LOW31) << _U(32)


def encode(ids: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Blocks of the ids: (number of ids, crc32 of the ids as little-endian 32-bit numbers, code)."""
    if len(ids) and int(ids.max()) >= (1 << 16) - 1:
        raise ValueError("ids up to 65,534 are supported")
    out = []
    for at in range(0, len(ids), BLOCK * ENCODE_LANES):
        out += _encode_lanes(ids[at : at + BLOCK * ENCODE_LANES])
    return out


def _encode_lanes(ids: np.ndarray) -> list[tuple[int, int, bytes]]:
    lanes = -(-len(ids) // BLOCK)
    steps = min(BLOCK, len(ids))
    padded = np.zeros(lanes * BLOCK, np.uint16)
    padded[: len(ids)] = ids
    table = np.ascontiguousarray(padded.reshape(lanes, BLOCK)[:, :steps].T)
    model = _Model(lanes)
    words = np.zeros((steps + 3, lanes), _U)  # an id fills less than one word; word k of a lane in row k
    flat, at = words.reshape(-1), np.zeros(lanes, np.int64)
    low, width = np.zeros(lanes, _U), np.full(lanes, 2**63 - 1, _U)
    before = np.zeros((2, lanes), np.uint32)
    for t0 in range(0, steps, TURN):
        turn = table[t0 : t0 + TURN].astype(np.uint32)
        past = np.concatenate([before, turn])
        before = past[-2:]
        c1, c2 = model.contexts(past[1:-1], past[:-2])
        guess, state = model.predict(c1, c2)
        hit = (guess == turn + 1) & (state > 0)
        weight = model.weight[model.row * _STATES + state]
        kind = CLASS_OF[turn]
        entry = model.entries[model.row * model.n_classes + kind]
        cum, freq = (entry >> _CUM_AT & _CUM).astype(_U), (entry & _FREQ).astype(_U)
        log, off = (entry >> _LOG_AT).astype(_U), (turn - FIRST[kind]).astype(_U)
        for k in range(len(turn)):
            bound = (width >> _U(WEIGHT_BITS)) * weight[k]
            unit = (width - bound) >> _U(CLASS_BITS)
            part = unit * freq[k] >> log[k]
            low += np.where(hit[k], _U(0), bound + unit * cum[k] + part * off[k])
            width = np.where(hit[k], bound, part)
            full = np.flatnonzero(width < _LEAST)
            if len(full):
                own = low[full]
                flat[at[full] * lanes + full] = own >> _U(31)
                at[full] += 1
                low[full] = _renew(own)
                width[full] <<= _U(32)
        model.update(turn, c1, c2, state, hit)
    for _ in range(2):
        flat[at * lanes + model.row] = low >> _U(31)
        low, at = _renew(low), at + 1
    for j in range(len(words) - 1, 0, -1):  # carries
        words[j - 1] += words[j] >> _U(32)
    stream = words.astype(np.uint32).astype(">u4").T
    del words, flat
    raw = ids.astype("<u4")
    return [
        (len(own := raw[i * BLOCK : (i + 1) * BLOCK]), zlib.crc32(own.tobytes()), stream[i, : at[i]].tobytes())
        for i in range(lanes)
    ]


def decode(blocks: list[tuple[int, int, bytes]]) -> np.ndarray:
    """The ids of the blocks, in order. A block whose checksum doesn't fit is an error."""
    parts = [_decode_lanes(blocks[i : i + DECODE_LANES]) for i in range(0, len(blocks), DECODE_LANES)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _decode_lanes(blocks: list[tuple[int, int, bytes]]) -> np.ndarray:
    lanes, steps = len(blocks), max(b[0] for b in blocks)
    length = max(len(b[2]) for b in blocks) // 4 + 3
    words = np.zeros((lanes, length), _U)
    for i, (_, _, code) in enumerate(blocks):
        got = np.frombuffer(code, ">u4")
        words[i, : len(got)] = got
    code = (words[:, 0] << _U(31)) | (words[:, 1] >> _U(1))
    more = (((words[:, 1:-1] & _U(1)) << _U(31)) | (words[:, 2:] >> _U(1))).astype(np.uint32).reshape(-1)
    at = np.arange(lanes) * (length - 2)
    end = at + length - 3  # a damaged block may ask for more than it has
    del words
    model = _Model(lanes)
    width = np.full(lanes, 2**63 - 1, _U)
    result = np.zeros((steps, lanes), np.uint16)
    one, two = np.zeros((2, lanes), np.uint32)
    firsts, last = FIRST.astype(np.uint32), _U((1 << CLASS_BITS) - 1)
    by_value, by_class, by_state = (model.row << CLASS_BITS, model.row * model.n_classes, model.row * _STATES)
    c1s, c2s = np.zeros((2, TURN, lanes), np.int64)
    states, hits = np.zeros((TURN, lanes), np.uint8), np.zeros((TURN, lanes), bool)
    for t0 in range(0, steps, TURN):
        inverse, n = model.inverse(), min(TURN, steps - t0)
        for k in range(n):
            c1, c2 = model.contexts(one, two)
            guess, state = model.predict(c1, c2)
            bound = (width >> _U(WEIGHT_BITS)) * model.weight[by_state + state]
            hit = code < bound
            rest = code - bound
            unit = (width - bound) >> _U(CLASS_BITS)
            kind = inverse[by_value + np.minimum(rest // unit, last).view(np.int64)]
            entry = model.entries[by_class + kind].astype(_U)
            rest -= unit * (entry >> _U(_CUM_AT) & _U(_CUM))
            log = entry >> _U(_LOG_AT)
            part = unit * (entry & _U(_FREQ)) >> log
            off = np.minimum(rest // part, (_U(1) << log) - _U(1))
            code = np.where(hit, code, rest - part * off)
            width = np.where(hit, bound, part)
            # Lanes that have ended may run on; what they make up is cut off below.
            one, two = np.where(hit, guess - np.uint16(1), (firsts[kind] + off.astype(np.uint32)).astype(np.uint16)), one
            c1s[k], c2s[k], states[k], hits[k], result[t0 + k] = c1, c2, state, hit, one
            one = one.astype(np.uint32)
            full = np.flatnonzero(width < _LEAST)
            if len(full):
                code[full] = (code[full] << _U(32)) | more[np.minimum(at[full], end[full])]
                width[full] <<= _U(32)
                at[full] += 1
        model.update(result[t0 : t0 + n], c1s[:n], c2s[:n], states[:n], hits[:n])
    rows = np.ascontiguousarray(result.T).astype("<u4")
    parts = []
    for i, (n, crc, _) in enumerate(blocks):
        if zlib.crc32(rows[i, :n].tobytes()) != crc:
            raise ValueError("a block's checksum doesn't fit its ids")
        parts.append(rows[i, :n])
    return np.concatenate(parts)
