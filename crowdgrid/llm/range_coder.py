"""An adaptive context-mixing range coder for token ids, many blocks side by side.

Every block is coded by itself and starts with empty models. Three models predict the next
id: order 2 and order 1 remember the id that followed the last two ids, and the last one,
and how often they were right; order 0 ranks the ids of the block by first occurrence and
spells out new ones. The mixture gives the two remembered ids adaptive weights, learnt for
every pair of confidences, and leaves the rest of the interval to order 0, whose rank
classes have adaptive frequencies. The interval is narrowed by an arithmetic coder of 64
bits that emits 32 at a time; a range that straddles a word is cut, so no carry runs back.

The steps are numpy operations over all blocks of a call, one id of each block at a time,
so the cost of a step is shared. Ids are below 2**24 and blocks of any size.
"""

from __future__ import annotations

import numpy as np

# Slots of the order-1 and order-2 tables of a block, as a power of two.
SLOT_BITS = 10
# Entries hold an id and, above it, how sure it is: 0 to 3.
ID_BITS = 24
NOTHING = (1 << ID_BITS) - 1
# Weights are parts of 2**SCALE, frequencies of 2**CLASS_SCALE; both are learnt by shifts.
SCALE = 12
CLASS_SCALE = 14
RATE = 5
# The least part of a weight and of a frequency.
LEAST = 32
# Steps after which the frequencies of rank classes are set anew; what a class met counts as
# much in the counts, of which an eighth is forgotten then.
PERIOD = 16
MET = 32
# A pair of weights in one number.
PAIR = SCALE + 1

_WORD = np.uint64(32)
_LOW = np.uint64((1 << 32) - 1)
_FULL = np.uint64(1 << 32)
_SLOTS = (1 << SLOT_BITS) - 1
_ONE = 1 << SCALE
_CLASS = (1 << CLASS_SCALE) - 1
# How sure an entry is next, by 2 * sure + right; one more where it was right, up to 3.
_SURER = (np.array([0, 1, 0, 2, 1, 3, 2, 3], dtype=np.int32)) << ID_BITS
# Weights move a part 2**-RATE of the way to one or the other end. Both of a pair move in one
# step, by whether order 1 (1) and order 2 (2) were right: order 1 rests where order 2 was right.
_UP, _DOWN = _ONE - LEAST >> RATE, LEAST >> RATE
_ROUND = ((1 << RATE) - 1) * (1 << PAIR | 1)
_PART = (1 << PAIR - RATE) - 1
_FALL = np.array([_PART << PAIR | _PART] * 2 + [_PART << PAIR] * 2, dtype=np.int32)
_RISE = np.array([_DOWN << PAIR | _DOWN, _DOWN << PAIR | _UP] + [_UP << PAIR] * 2, dtype=np.int32)


class _Models:
    """What all blocks of a call have learnt so far, a row of every table for each block.

    The classes of order 0 are a new id, and ranks by their number of binary digits.
    """

    def __init__(self, blocks: int, most_ids: int) -> None:
        self.every = every = np.arange(blocks, dtype=np.int64)
        # The tables of order 1, and after them those of order 2.
        self.entries = np.full(2 * blocks << SLOT_BITS, NOTHING, dtype=np.int32)
        self.base = np.arange(2 * blocks, dtype=np.int64).reshape(2, blocks) << SLOT_BITS
        self.weights = np.full(blocks << 5, (_ONE >> 2) << PAIR | _ONE >> 2, dtype=np.int32)
        self.weight_base = every << 5
        self.columns = 1 + most_ids.bit_length()
        self.met = np.full((blocks, self.columns), MET, dtype=np.int32)
        # Where each class begins in 2**CLASS_SCALE, the blocks one after the other.
        self.class_base = every << CLASS_SCALE
        self.begins = np.full(blocks * self.columns + 1, blocks << CLASS_SCALE, dtype=np.int64)
        self.slots = np.zeros((2, blocks), dtype=np.int64)
        self.last = np.zeros(blocks, dtype=np.int64)
        self._bounds()

    def _bounds(self) -> None:
        """Where the shares of the interval begin: order 2, order 1, order 0, and the end."""
        self.bounds = np.zeros((4, len(self.last)), dtype=np.uint64)
        self.bounds[3] = _ONE

    def shorten(self, blocks: int) -> None:
        """Go on with the first blocks only; the others are done."""
        self.base, self.weight_base = self.base[:, :blocks], self.weight_base[:blocks]
        self.slots, self.last = self.slots[:, :blocks], self.last[:blocks]
        self.every = self.every[:blocks]
        self._bounds()

    def predict(self) -> None:
        """The ids that order 1 and order 2 remember, and the bounds of their shares."""
        self.at = self.base + self.slots
        entry = self.entries.take(self.at)
        self.known, self.sure = entry & NOTHING, entry >> ID_BITS
        context = self.sure[1] << 3 | self.sure[0] << 1 | (self.known[0] == self.known[1])
        self.where = self.weight_base + context
        self.pair = self.weights.take(self.where)
        w2, w1 = self.pair >> PAIR, self.pair & (1 << PAIR) - 1
        self.bounds[1] = w2
        self.bounds[2] = w2 + ((_ONE - w2) * w1 >> SCALE)

    def shares(self, case: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the share of every block begins, and its width: 0 for order 2, 1 for order 1
        and 2 for order 0."""
        at = case * np.int64(len(case)) + self.every
        start = self.bounds.take(at)
        at += len(case)
        return start, self.bounds.take(at) - start

    def learn(self, ids: np.ndarray, right: np.ndarray) -> None:
        """Move weights and entries towards the id that came; ``right`` for either order."""
        which = right[1].view(np.int8) << 1 | right[0].view(np.int8)
        fall = self.pair + _ROUND >> RATE & _FALL.take(which)
        self.weights[self.where] = self.pair - fall + _RISE.take(which)
        # The next entry: surer where it was right, else less sure, or replaced.
        kept = self.known | _SURER.take(self.sure << 1 | right)
        self.entries[self.at] = np.where(self.sure | right, kept, ids)
        self.slots[1] = ids * 7919 + self.last * 26227 >> 3 & _SLOTS
        self.last = ids.astype(np.int64)
        self.slots[0] = self.last * 40503 >> 4 & _SLOTS

    def set_classes(self) -> None:
        """The frequencies of the classes by what was met, every class keeping a share."""
        met, live = self.met[: len(self.last)], len(self.last) * self.columns
        sums = met.cumsum(axis=1, dtype=np.int64)
        spread = (1 << CLASS_SCALE) - LEAST * self.columns
        begins = self.begins[:live].reshape(met.shape)
        begins[:, 0] = 0
        begins[:, 1:] = sums[:, :-1] * spread // sums[:, -1:] + LEAST * np.arange(1, self.columns)
        self.inside = np.ascontiguousarray(begins[:, 1:].T, dtype=np.int16)
        begins += self.class_base[: len(met), None]
        met -= met >> 3

    def class_of(self, lanes: np.ndarray, part: np.ndarray) -> np.ndarray:
        """The class whose share of the interval ``part`` lies in."""
        return (self.inside.take(lanes, axis=1) <= part.astype(np.int16)).sum(axis=0)

    def share(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the class at a place begins, and its frequency."""
        begin = self.begins.take(place)
        share = self.begins.take(place + 1) - begin
        return (begin & _CLASS).view(np.uint64), share.view(np.uint64)

    def learn_class(self, place: np.ndarray) -> None:
        self.met.ravel()[place] += MET


def _ranks(ids: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """1 + the rank by first occurrence of every id that came before, 0 for a new one."""
    places = np.arange(len(ids), dtype=np.int32)
    scratch[ids[::-1]] = places[::-1]
    first = scratch[ids]
    new = first == places
    rank = new.cumsum()[first]
    rank[new] = 0
    return rank


def _kinds(id_bits: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every class: the binary digits that tell its members apart, and its least rank."""
    digits = np.array([id_bits, *range(columns - 1)], dtype=np.uint64)
    return digits, np.array([0, *(1 << d for d in range(columns - 1))], dtype=np.int64)


class _Interval:
    """The interval of every block: its lower end and its width."""

    def __init__(self, blocks: int) -> None:
        self.low = np.zeros(blocks, dtype=np.uint64)
        self.width = np.full(blocks, (1 << 64) - 1, dtype=np.uint64)

    def lead(self, lanes: np.ndarray) -> np.ndarray:
        """The leading words of ``lanes``, whose width is below 2**32; shifted out."""
        low = self.low.take(lanes)
        rest = low & _LOW
        self.width[lanes] = np.minimum(self.width.take(lanes), _FULL - rest) << _WORD
        self.low[lanes] = rest << _WORD
        return low >> _WORD


def _arranged(sizes: list[int]) -> tuple[list[int], np.ndarray]:
    """Blocks from the longest to the shortest, and their sizes."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    return order, np.array([sizes[i] for i in order], dtype=np.int64)


def encode(blocks: list[np.ndarray], id_bits: int, most_ids: int) -> list[bytes]:
    """The code of every block of at most ``most_ids`` ids below ``2**id_bits``."""
    order, sizes = _arranged([len(b) for b in blocks])
    count, longest = len(order), int(sizes[0]) if order else 0
    out: list[bytes] = [b""] * len(blocks)
    if not longest:
        return out
    ids = np.zeros((longest, count), dtype=np.int32)
    ranks = np.zeros((longest, count), dtype=np.int32)
    scratch = np.zeros(1 << id_bits, dtype=np.int32)
    for lane, i in enumerate(order):
        ids[: sizes[lane], lane] = blocks[i]
        ranks[: sizes[lane], lane] = _ranks(ids[: sizes[lane], lane], scratch)
    models, interval = _Models(count, most_ids), _Interval(count)
    digits_of, least_of = _kinds(id_bits, models.columns)
    kind_of = np.array([r.bit_length() for r in range(most_ids + 1)], dtype=np.int64)
    # The words that have left, with the block of each.
    left: list[np.ndarray] = []
    blocks_left: list[np.ndarray] = []

    def emit(lanes: np.ndarray) -> None:
        left.append(interval.lead(lanes).astype(np.uint32))
        blocks_left.append(lanes.astype(np.int32))

    for step, live in enumerate(_live(sizes, longest)):
        if live < count:
            count = live
            models.shorten(live)
        if step % PERIOD == 0:
            models.set_classes()
        low, width, now = interval.low[:count], interval.width[:count], ids[step, :count]
        models.predict()
        right = now == models.known
        wrong = ~right
        start, share = models.shares(wrong[1].view(np.int8) + (wrong[0] & wrong[1]))
        unit = width >> np.uint64(SCALE)
        low += unit * start
        np.multiply(unit, share, out=width)
        narrow = np.flatnonzero(width < _FULL)
        if len(narrow):
            emit(narrow)
        missed = np.flatnonzero(wrong[0] & wrong[1])
        if len(missed):
            rank = ranks[step].take(missed)
            kind = kind_of.take(rank)
            rest = np.where(rank == 0, now.take(missed), rank - least_of.take(kind))
            place = missed * models.columns + kind
            start, share = models.share(place)
            unit = width.take(missed) >> np.uint64(CLASS_SCALE)
            unit_rest = unit * share >> digits_of.take(kind)
            low[missed] += unit * start + unit_rest * rest.view(np.uint64)
            width[missed] = unit_rest
            models.learn_class(place)
            narrow = missed[unit_rest < _FULL]
            if len(narrow):
                emit(narrow)
        models.learn(now, right)
    # The lower end of the last interval names it.
    every = np.arange(len(order), dtype=np.int32)
    left += [(interval.low >> _WORD).astype(np.uint32), (interval.low & _LOW).astype(np.uint32)]
    blocks_left += [every, every]
    owner = np.concatenate(blocks_left)
    words = np.concatenate(left)[np.argsort(owner, kind="stable")].astype("<u4")
    ends = np.cumsum(np.bincount(owner, minlength=len(order)))
    for i, size, start, end in zip(order, sizes, np.append(0, ends), ends):
        if size:
            out[i] = words[start:end].tobytes()
    return out


def decode(
    codes: list[bytes], sizes: list[int], id_bits: int, most_ids: int
) -> list[np.ndarray]:
    """The ids of every block, given how many there are, and what ``encode`` was given."""
    order, sizes_ = _arranged(sizes)
    count, longest = len(order), int(sizes_[0]) if order else 0
    if not longest:
        return [np.zeros(0, dtype=np.uint32) for _ in codes]
    models, interval = _Models(count, most_ids), _Interval(count)
    digits_of, least_of = _kinds(id_bits, models.columns)
    # The words of all blocks in a row; a block that is read past its end meets the next.
    given = [np.frombuffer(codes[i], dtype="<u4") for i in order]
    words = np.concatenate([*given, np.zeros(2, dtype="<u4")]).astype(np.uint64)
    read = np.cumsum([0, *map(len, given)])[:-1]
    code = words[read] << _WORD | words[read + 1]
    read += 2
    last = len(words) - 1
    ids = np.zeros((longest, count), dtype=np.int32)
    # The ids of every block in the order of their first occurrence, from 1.
    seen = np.zeros((count, longest + 1), dtype=np.int32)
    known = np.zeros(count, dtype=np.int64)

    def refill(lanes: np.ndarray) -> None:
        interval.lead(lanes)
        at = read.take(lanes)
        code[lanes] = code.take(lanes) << _WORD | words.take(np.minimum(at, last))
        read[lanes] = at + 1

    for step, live in enumerate(_live(sizes_, longest)):
        if live < count:
            count = live
            models.shorten(live)
        if step % PERIOD == 0:
            models.set_classes()
        low, width = interval.low[:count], interval.width[:count]
        models.predict()
        unit = width >> np.uint64(SCALE)
        place = code[:count] - low
        past2 = place >= unit * models.bounds[1]
        miss = place >= unit * models.bounds[2]
        start, share = models.shares(past2.view(np.int8) + miss)
        low += unit * start
        np.multiply(unit, share, out=width)
        narrow = np.flatnonzero(width < _FULL)
        if len(narrow):
            refill(narrow)
        now = np.where(past2, models.known[0], models.known[1])
        missed = np.flatnonzero(miss)
        if len(missed):
            unit = width.take(missed) >> np.uint64(CLASS_SCALE)
            place = code.take(missed) - low.take(missed)
            kind = models.class_of(missed, place // unit)
            at = missed * models.columns + kind
            start, share = models.share(at)
            skipped = unit * start
            unit_rest = unit * share >> digits_of.take(kind)
            rest = ((place - skipped) // unit_rest).view(np.int64)
            low[missed] += skipped + unit_rest * rest.view(np.uint64)
            width[missed] = unit_rest
            models.learn_class(at)
            new = kind == 0
            met = seen.take(missed * seen.shape[1] + (rest + least_of.take(kind)) * ~new)
            found = np.where(new, rest, met)
            now[missed] = found
            fresh = missed[new]
            known[fresh] += 1
            seen[fresh, known[fresh]] = found[new]
            narrow = missed[unit_rest < _FULL]
            if len(narrow):
                refill(narrow)
        ids[step, :count] = now
        models.learn(now, now == models.known)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(codes)
    for lane, i in enumerate(order):
        out[i] = ids[: sizes_[lane], lane].astype(np.uint32)
    return out


def _live(sizes: np.ndarray, longest: int) -> list[int]:
    """How many of the blocks, from the longest, have an id at each step."""
    return np.searchsorted(-sizes, -np.arange(longest), side="left").tolist()
