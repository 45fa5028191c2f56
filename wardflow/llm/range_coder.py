"""Adaptive context-mixing range coder for token ids below 65,536, over many blocks at once.

Every block starts from the same state and can be decoded alone.  Within a block three models
predict the next id: order 2 and order 1 remember, by hash of the last two ids or of the last one,
which id followed; order 0 counts the ids' digits.  An id is coded as who guessed it,

    a [order 2] + (1 - a) b [order 1] + (1 - a) (1 - b) [neither],

whose weights a and b adapt, each in the context of which models guessed right the last two times
and whether both guess the same now, and, if neither did, as its digits under order 0: the high one
and, in the context of its group, the low one.  Both go into one interval of the range coder, whose
carries are settled when a block ends.

Blocks lie side by side as lanes of numpy arrays: one step codes the next id of each.  What does
not depend on the lane's state is looked up for many steps, and counts are taken when they are
looked at again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 4096  # ids of a block
LANES = 2048  # blocks coded side by side

_SLOT_BITS = 11
_FLAG_BITS, _DIGIT_BITS = 16, 12
_RENEW = (48, 256, 1024, 2304)  # ids after which order 0 looks at its counts again
_STEP = 32  # ids of a lane looked up together

# Groups of high digits, for the counts of low ones: small ids are the more frequent ones.
_BOUNDS = (1, 3, 8, 32)
_GROUPS = len(_BOUNDS) + 1
_LIMITS = [np.uint8(x) for x in _BOUNDS]

# Both weights lie in one number, a in its low half; each moves 1/32 of its way to 64 or 63,040.
_LOWER, _RIGHT, _STILL = 0x07FF, 1968, 2

# The coder's state has 62 bits and puts out 16 at a time.
_U = np.uint64
_WORD, _LEAST = _U(16), _U(1 << 46)
_KEPT = _U((1 << 46) - 1)
_PASSED = np.uint32(1 << 2 * _DIGIT_BITS)  # the whole interval, for ids that were guessed
_MASK, _HALF, _ALL = np.uint32(0xFFFF), np.uint32(16), np.uint32(1 << _FLAG_BITS)
_ONE, _TWO = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


class _Model:
    """Predictions for ``lanes`` lanes, of which the first ``n`` still have ids.

    Choices among lanes are sums of products with 0 or 1, which numpy makes faster than it chooses:
    ``not_two`` where order 2 is wrong, ``missed`` where order 1 is as well.
    """

    def __init__(self, lanes: int, inverse: bool):
        self.guess = np.zeros(2 * lanes << _SLOT_BITS, np.uint16)
        self.weight = np.full(lanes * 32, 8192 << 16 | 8192, np.uint32)
        prior = np.maximum(1, 128 // (np.arange(256) + 1)).astype(np.uint16)
        self.high = np.tile(prior, (lanes, 1))
        self.low = np.full((lanes * _GROUPS, 256), 1, np.uint16)
        self.lanes, self.inverse = lanes, inverse
        self.past = np.zeros(lanes, np.uint8)  # orders that guessed the last two ids
        self.narrow(lanes)
        # at first all lanes are alike
        self.renew(1)
        self.high_share, self.low_share = np.tile(self.high_share, lanes), np.tile(self.low_share, lanes)
        if inverse:
            self.high_digit, self.low_digit = np.tile(self.high_digit, lanes), np.tile(self.low_digit, lanes)

    def narrow(self, n: int) -> None:
        """Goes on with the first ``n`` lanes."""
        self.n, self.lane = n, np.arange(n)
        self.past = self.past[:n]
        self.slots = np.concatenate([self.lane, self.lane + self.lanes]) << _SLOT_BITS
        self.contexts = self.lane << 5

    def count(self, ids: np.ndarray) -> None:
        """Counts ids, a row for each step, and renews the sums."""
        high = (ids >> 8).astype(np.uint8)
        self.high[: self.n] += _counted((self.lane << 8) + high, self.n)
        at = ((self.lane * _GROUPS + _groups(high)) << 8) + (ids & np.uint16(255))
        self.low[: self.n * _GROUPS] += _counted(at, self.n * _GROUPS)
        self.renew(self.n)

    def renew(self, n: int) -> None:
        self.high_share = _shares(self.high[:n])
        self.low_share = _shares(self.low[: n * _GROUPS])
        if self.inverse:
            self.high_digit, self.low_digit = _digits(self.high_share), _digits(self.low_share)

    def look(self, slot: np.ndarray) -> None:
        """Guesses and weights for the next id of each lane."""
        found = self.guess.take(slot)
        self.two, self.one = found[: self.n], found[self.n :]
        self.context = self.contexts + (self.past << np.uint8(1) | (self.two == self.one))
        self.now = self.weight.take(self.context)
        self.a = self.now & _MASK
        self.part = ((_ALL - self.a) * (self.now >> _HALF)) >> _HALF
        self.both = self.a + self.part

    def interval(self, not_two: np.ndarray, missed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of who guessed the id."""
        a, part = self.a, self.part
        size = a + not_two * (part - a) + missed * (_ALL - self.both - part)
        return a * not_two + part * missed, size

    def learn(self, slot: np.ndarray, ids: np.ndarray, not_two: np.ndarray, missed: np.ndarray) -> None:
        """``ids`` twice, once for each order's slots."""
        # order 1's weight stays where order 2 is right
        less = (self.now >> np.uint32(5)) & (np.uint32(_LOWER) + not_two * np.uint32(_LOWER << 16))
        more = not_two * np.uint32((_RIGHT + _STILL << 16) - _RIGHT) - missed * np.uint32(_RIGHT << 16)
        self.weight[self.context] = self.now - less + (more + np.uint32(_RIGHT + _STILL))
        self.guess[slot] = ids
        # 0 for order 2, 1 for order 1, 2 for neither
        self.past = (self.past & np.uint8(3)) << np.uint8(2) | (not_two + missed).astype(np.uint8)


def _groups(high: np.ndarray) -> np.ndarray:
    """The group of each high digit, as unsigned bytes."""
    out = (high >= _LIMITS[0]).view(np.uint8)
    for limit in _LIMITS[1:]:
        out = out + (high >= limit)
    return out


def _counted(at: np.ndarray, rows: int) -> np.ndarray:
    return (np.bincount(at.ravel(), minlength=rows << 8) * 6).astype(np.uint16).reshape(rows, 256)


def _shares(counts: np.ndarray) -> np.ndarray:
    """For each digit its start in the low 16 bits and its size, at least 1, in the high ones."""
    total = np.cumsum(counts, axis=-1, dtype=np.uint32)
    # whole-number arithmetic, so that every machine gets the same sums
    share = np.uint32(((1 << _DIGIT_BITS) - 256) << 16) // total[:, -1:]
    total *= share
    total >>= np.uint32(16)
    total += np.arange(1, 257, dtype=np.uint32)
    total[:, 255] = 1 << _DIGIT_BITS
    out = total << np.uint32(16)
    out[:, 1:] -= (total[:, :-1] << np.uint32(16)) - total[:, :-1]
    return out.ravel()


def _digits(shares: np.ndarray) -> np.ndarray:
    """The digit of every value below 2 ** ``_DIGIT_BITS``, for each row of shares."""
    digit = np.arange(256, dtype=np.uint8)
    return np.repeat(np.tile(digit, len(shares) >> 8), shares >> np.uint32(16))


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
    """Steps of a constant number of lanes: first, stop, lanes, and whether counts are due first."""
    stops = set(np.unique(sizes).tolist()) | {x for x in _RENEW if x < sizes[0]}
    first = 0
    for stop in sorted(stops):
        yield first, stop, int(np.searchsorted(-sizes, -first, "left")), first in _RENEW
        first = stop


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids (unsigned 16-bit) as bytes."""
    out: list[bytes] = [b""] * len(blocks)
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    for at in range(0, len(order), LANES):
        group = order[at : at + LANES]
        for k, coded in zip(group, _encode([blocks[k] for k in group]), strict=True):
            out[k] = coded
    return out


class _Writer:
    """The range coder's state of each lane, and its words; a carry is the 17th bit of a word."""

    def __init__(self, lanes: int, steps: int):
        self.low, self.span = np.zeros(lanes, _U), np.full(lanes, 1 << 62, _U)
        self.used = np.zeros(lanes, np.int64)
        self.words = np.zeros((lanes, 128 + steps * 3 // 4), np.uint32)
        self.narrow(lanes)

    def narrow(self, n: int) -> None:
        self.n = n
        self.base = np.arange(len(self.used)) * self.words.shape[1]
        self.flat = self.words.ravel()

    def room(self, words: int) -> None:
        if int(self.used.max()) + words > self.words.shape[1]:
            self.words = np.pad(self.words, ((0, 0), (0, words + self.words.shape[1] // 2)))
            self.narrow(self.n)

    def put(self, start: np.ndarray, size: np.ndarray, digits: np.ndarray, width: np.ndarray) -> None:
        n = self.n
        low, span, used = self.low[:n], self.span[:n], self.used[:n]
        unit = span >> _U(_FLAG_BITS)
        low += unit * start
        unit *= size
        unit >>= _U(2 * _DIGIT_BITS)
        low += unit * digits
        np.multiply(unit, width, out=span)
        # every lane notes a word; where none was due the next one takes its place
        self.flat[self.base[:n] + used] = low >> _U(46)
        due = (span < _LEAST).astype(_U)
        used += due.view(np.int64)
        low &= (due - _U(1)) | _KEPT
        due <<= _U(4)
        low <<= due
        span <<= due
        more = np.flatnonzero(span < _LEAST)
        while len(more):
            self.flat[self.base[more] + used[more]] = low[more] >> _U(46)
            used[more] += 1
            low[more] = (low[more] & _KEPT) << _WORD
            span[more] <<= _WORD
            more = more[span[more] < _LEAST]

    def ended(self) -> list[bytes]:
        """The words of each lane.  The last is the least that lies in its interval; the rest are 0."""
        lane = np.arange(len(self.used))
        self.words[lane, self.used] = (self.low + _KEPT) >> _U(46)
        self.words[np.arange(self.words.shape[1]) > self.used[:, None]] = 0
        words = self.words[:, : int(self.used.max()) + 1]
        while len(carry := np.flatnonzero(words.ravel() > 0xFFFF)):
            lane, at = np.divmod(carry, words.shape[1])
            words[lane, at] &= np.uint32(0xFFFF)
            words[lane, at - 1] += np.uint32(1)
        words = words.astype("<u2")
        return [words[k, : n + 1].tobytes() for k, n in enumerate(self.used.tolist())]


def _encode(blocks: list[np.ndarray]) -> list[bytes]:
    lanes, sizes = len(blocks), np.array([len(b) for b in blocks])
    steps = int(sizes[0])
    ids = np.zeros((2 + steps, lanes), np.uint16)  # after two ids 0
    for k, block in enumerate(blocks):
        ids[2 : 2 + len(block), k] = block
    model, writer = _Model(lanes, False), _Writer(lanes, steps)
    counted = 0
    for first, stop, n, due in _spans(sizes):
        if n < model.n:
            model.narrow(n)
            writer.narrow(n)
        if due:
            model.count(ids[2 + counted : 2 + first, :n])
            counted = first
        for at in range(first, stop, _STEP):
            rows = min(_STEP, stop - at)
            writer.room(4 * _STEP)
            slots, digits, width = _looked_up(model, ids[at : at + rows + 2, :n])
            twice = np.tile(ids[2 + at : 2 + at + rows, :n], (1, 2))
            for k in range(rows):
                now, slot = ids[2 + at + k, :n], slots[k]
                model.look(slot)
                differs = now != model.two
                missed = (differs & (now != model.one)).astype(np.uint32)
                not_two = differs.astype(np.uint32)
                start, size = model.interval(not_two, missed)
                writer.put(start, size, missed * digits[k], missed * width[k] + _PASSED)
                model.learn(slot, twice[k], not_two, missed)
    return writer.ended()


def _looked_up(model: _Model, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the third row of ids and on: slots of both orders, and start and size under order 0.

    The size is told by how much it differs, below 2^32, from the whole interval.
    """
    n, shift = model.n, np.uint32(32 - _SLOT_BITS)
    one, two = ids[1:-1] * _ONE, ids[:-2] * _TWO
    slots = np.tile(model.slots, (len(one), 1))
    slots[:, :n] += (one + two) >> shift
    slots[:, n:] += one >> shift
    high, low = (ids[2:] >> 8).astype(np.uint8), ids[2:] & np.uint16(255)
    share = model.high_share.take((model.lane << 8) + high)
    under = model.low_share.take(((model.lane * _GROUPS + _groups(high)) << 8) + low)
    size = share >> _HALF
    start = ((share & _MASK) << np.uint32(_DIGIT_BITS)) + (under & _MASK) * size
    return slots, start, size * (under >> _HALF) - _PASSED


def decode(coded: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block, given how many there are."""
    out: list[np.ndarray] = [np.zeros(0, np.uint16)] * len(coded)
    order = sorted(range(len(coded)), key=lambda k: -sizes[k])
    for at in range(0, len(order), LANES):
        group = order[at : at + LANES]
        found = _decode([coded[k] for k in group], np.array([sizes[k] for k in group]))
        for k, ids in zip(group, found, strict=True):
            out[k] = ids
    return out


def _decode(coded: list[bytes], sizes: np.ndarray) -> list[np.ndarray]:
    lanes = len(coded)
    words = [np.frombuffer(c[: len(c) & ~1], "<u2") for c in coded]
    data = np.zeros((lanes, max(len(w) for w in words) + 8), np.uint16)
    for k, w in enumerate(words):
        data[k, : len(w)] = w
    offset, span = np.zeros(lanes, _U), np.full(lanes, 1 << 62, _U)
    for k in range(4):
        offset = offset << _WORD | data[:, k]
    offset >>= _U(2)
    # the state ends two bits before a word does
    data[:, :-1] = data[:, :-1] << np.uint16(14) | data[:, 1:] >> np.uint16(2)
    # what a damaged block asks for beyond its words is some other word, and does no harm
    words, used = data.ravel(), np.arange(lanes) * data.shape[1] + 3
    model = _Model(lanes, True)
    ids = np.zeros((2 + int(sizes[0]), lanes), np.uint16)
    counted, shift = 0, np.uint32(32 - _SLOT_BITS)
    digit_bits = np.uint32(_DIGIT_BITS)
    for first, stop, n, due in _spans(sizes):
        if n < model.n:
            model.narrow(n)
            offset, span, used = offset[:n], span[:n], used[:n]
        if due:
            model.count(ids[2 + counted : 2 + first, :n])
            counted = first
        highs, lows, lane_values = model.lane << 8, model.lane * _GROUPS, model.lane << _DIGIT_BITS
        slot = np.empty(2 * n, np.int64)
        both = np.empty(2 * n, np.uint16)
        two = ids[first, :n] * _TWO
        for t in range(first + 2, stop + 2):
            last = ids[t - 1, :n]
            one = last * _ONE
            np.add(model.slots[:n], (one + two) >> shift, out=slot[:n])
            np.add(model.slots[n:], one >> shift, out=slot[n:])
            two = last * _TWO
            model.look(slot)
            # who guessed it
            unit = span >> _U(_FLAG_BITS)
            value = (offset // unit).astype(np.uint32)
            not_two, missed = value >= model.a, value >= model.both
            from_two, from_one = not_two.astype(np.uint16), missed.astype(np.uint16)
            not_two, missed = not_two.astype(np.uint32), missed.astype(np.uint32)
            start, size = model.interval(not_two, missed)
            offset -= unit * start
            unit *= size
            # its digits, of use where nobody did
            unit >>= _U(2 * _DIGIT_BITS)
            value = (offset // unit).astype(np.uint32)
            high = model.high_digit.take(lane_values + (value >> digit_bits), mode="clip")
            share = model.high_share.take(highs + high)
            size = share >> _HALF
            start = (share & _MASK) << digit_bits
            group = lows + _groups(high)
            low = model.low_digit.take((group << _DIGIT_BITS) + (value - start) // size, mode="clip")
            share = model.low_share.take((group << 8) + low)
            start += (share & _MASK) * size
            offset -= unit * (missed * start)
            np.multiply(unit, missed * (size * (share >> _HALF) - _PASSED) + _PASSED, out=span)
            due_word = (span < _LEAST).astype(_U)
            more = due_word << _U(4)
            offset <<= more
            offset |= words.take(used, mode="clip") * due_word
            span <<= more
            used += due_word.view(np.int64)
            rest = np.flatnonzero(span < _LEAST)
            while len(rest):
                offset[rest] = offset[rest] << _WORD | words.take(used[rest], mode="clip")
                used[rest] += 1
                span[rest] <<= _WORD
                rest = rest[span[rest] < _LEAST]
            now = high.astype(np.uint16) << np.uint16(8) | low
            now = model.two + from_two * (model.one - model.two) + from_one * (now - model.one)
            ids[t, :n] = both[:n] = both[n:] = now
            model.learn(slot, both, not_two, missed)
    return [ids[2 : 2 + size, k].copy() for k, size in enumerate(sizes.tolist())]
