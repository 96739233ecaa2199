"""A context-mixing range coder for token ids, many blocks side by side, mixed by tables.

Three models predict the next id, as in ``range_coder``: order 2 and order 1 remember the id
that followed the last two ids, and the last one, and how sure that is; order 0 ranks the ids
of the block by first occurrence and spells out new ones. Every block starts with empty
models. How much of the interval the two remembered ids, a new id and each class of ranks
get is set by what the models know: for every pair of confidences, by whether both name one
id, and by how many ids the block has shown. A first pass over all blocks of a call counts
what came true under each of these; the frequencies are kept in tables beside the codes, so
no step learns them and neither symbol nor class is searched.

The steps are numpy operations over all blocks of a call, one id of each block at a time.
The arithmetic coder has 64 bits and emits 32 at a time; a range that straddles a word is
cut, so no carry runs back. Ids are below 2**24 - 1 and blocks of any size.
"""

from __future__ import annotations

import zlib

import numpy as np

from crowdgrid.llm.range_coder import ID_BITS, NOTHING, _arranged, _live

# Slots of the order-1 and order-2 tables of a block, as a power of two.
SLOT_BITS = 9
# Frequencies are parts of 2**SCALE.
SCALE = 12
# Pairs of confidences from 0 to 3, and whether both orders name one id.
CONTEXTS = 32
# The members of a class of ranks have the same first digits, so many of them; so have those
# of a class of numbers of known ids.
RANK_DIGITS = 3
KNOWN_DIGITS = 3
# Steps that are counted at once.
COUNTED = 64
# Symbols: the id of order 2, that of order 1, a new one; from 3, ranks by binary digits.
ORDER_2, ORDER_1, NEW = range(3)

_WORD = np.uint64(32)
_LOW = np.uint64((1 << 32) - 1)
_FULL = np.uint64(1 << 32)
_SCALE = np.uint64(SCALE)
_SLOTS = (1 << SLOT_BITS) - 1
_SURE = 1 << ID_BITS
_SUREST = (4 << ID_BITS) - 1


def _classes(most: int, first_digits: int) -> list[int]:
    """The least member of every class of the numbers from 1 to ``most``."""
    least = [1]
    while least[-1] + _spread(least[-1], first_digits) <= most:
        least.append(least[-1] + _spread(least[-1], first_digits))
    return least


def _spread(least: int, first_digits: int) -> int:
    return 1 << max(0, least.bit_length() - first_digits)


def _by_member(most: int, least: list[int], values: list[int]) -> np.ndarray:
    """The value of the class of every number from 0 to ``most``; 0 is before all classes."""
    return np.repeat(np.array(values, dtype=np.int32), np.diff([0, *least, most + 1]))


class _Symbols:
    """What every symbol stands for: the digits that tell its members apart, and where they
    begin among the remembered ids (0 and 1) and the ranks (from 2). A row of the tables is a
    class of known ids with a context."""

    def __init__(self, id_bits: int, most_ids: int) -> None:
        most = max(1, min(most_ids, 1 << id_bits))
        ranks, known = _classes(most, RANK_DIGITS), _classes(most, KNOWN_DIGITS)
        digits = [_spread(r, RANK_DIGITS).bit_length() - 1 for r in ranks]
        self.count, self.rows = 3 + len(ranks), (1 + len(known)) * CONTEXTS
        self.digits = np.array([0, 0, id_bits, *digits], dtype=np.uint64)
        self.begins = np.array([0, 1, 0, *(1 + r for r in ranks)], dtype=np.int64)
        self.least = np.array([1 << max(0, int(d) - 16) for d in self.digits], dtype=np.int64)
        # By rank, 0 for a new id: its symbol and the least rank of that.
        self.symbol_of = _by_member(most, ranks, range(NEW, self.count))
        self.least_of = _by_member(most, ranks, [0, *ranks])
        # By the number of known ids: the first row.
        self.row_of = _by_member(most, known, range(0, self.rows, CONTEXTS))
        self.place = np.min_scalar_type(self.rows * self.count)

    def of_places(self, values: np.ndarray) -> np.ndarray:
        """The value of every symbol, once for each row."""
        return np.tile(values, self.rows)

    def frequencies(self, counts: np.ndarray) -> np.ndarray:
        """Parts of 2**SCALE by counts, at least the least where a symbol came at all."""
        counts = counts.reshape(self.rows, self.count)
        least = np.where(counts > 0, self.least, 0)
        spread = (1 << SCALE) - least.sum(axis=1, keepdims=True)
        parts = least + counts * spread // np.maximum(counts.sum(axis=1, keepdims=True), 1)
        # What rounding leaves over goes to the most frequent one.
        parts[np.arange(self.rows), counts.argmax(axis=1)] += (1 << SCALE) - parts.sum(axis=1)
        return parts


class _Models:
    """What all blocks of a call remember; the tables of order 1, and after them of order 2."""

    def __init__(self, blocks: int) -> None:
        self.entries = np.full(2 * blocks << SLOT_BITS, NOTHING, dtype=np.int32)
        self.base = np.arange(2 * blocks, dtype=np.int64).reshape(2, blocks) << SLOT_BITS
        self.at = self.base.copy()
        self.last = np.zeros(blocks, dtype=np.int64)

    def shorten(self, blocks: int) -> None:
        """Go on with the first blocks only; the others are done."""
        self.base, self.at = self.base[:, :blocks].copy(), self.at[:, :blocks].copy()
        self.last = self.last[:blocks]

    def predict(self) -> np.ndarray:
        """The ids that order 1 and order 2 remember, and the context of every block."""
        self.entry = self.entries.take(self.at)
        self.known = self.entry & NOTHING
        sure = self.entry >> ID_BITS
        context = sure[1] << 2
        context |= sure[0]
        context <<= 1
        context |= self.known[0] == self.known[1]
        return context

    def learn(self, ids: np.ndarray, right: np.ndarray) -> None:
        """A remembered id is surer where it was right, else less sure, or replaced."""
        entry = self.entry.ravel()
        surer = np.flatnonzero(right)
        raised = entry.take(surer)
        raised += _SURE * (raised < 3 * _SURE)
        self.entry -= _SURE
        np.copyto(self.entry, ids, where=self.entry < 0)
        entry[surer] = raised
        self.entries[self.at.ravel()] = entry
        self.last *= 26227
        self.last += ids * np.int64(7919)
        self.last >>= 3
        self.last &= _SLOTS
        np.add(self.base[1], self.last, out=self.at[1])
        self.last[:] = ids
        slot = self.last * 40503
        slot >>= 4
        slot &= _SLOTS
        np.add(self.base[0], slot, out=self.at[0])


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


def _ranks(ids: np.ndarray, places: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """1 + the rank by first occurrence of every id that came before, 0 for a new one."""
    scratch[ids[::-1]] = places[::-1]
    first = scratch.take(ids)
    new = first == places
    rank = new.cumsum(dtype=np.int32).take(first)
    rank[new] = 0
    return rank


def encode(blocks: list[np.ndarray], id_bits: int, most_ids: int) -> tuple[list[bytes], bytes]:
    """The code of every block of at most ``most_ids`` ids below ``2**id_bits``, and the
    tables that ``decode`` needs to read any of them."""
    symbols = _Symbols(id_bits, most_ids)
    order, sizes = _arranged([len(b) for b in blocks])
    count, longest = len(order), int(sizes[0]) if order else 0
    out: list[bytes] = [b""] * len(blocks)
    counts = np.zeros(symbols.rows * symbols.count, dtype=np.int64)
    if not longest:
        return out, _tables(symbols.frequencies(counts))
    ids = np.zeros((longest, count), dtype=np.int32)
    rest = np.zeros((longest, count), dtype=np.int32)
    scratch = np.zeros(1 << id_bits, dtype=np.int32)
    places = np.arange(longest, dtype=np.int32)
    for at, i in enumerate(order):
        block = blocks[i].astype(np.int64)
        ids[: sizes[at], at] = block
        rest[: sizes[at], at] = _ranks(block, places[: sizes[at]], scratch)
    lives = _live(sizes, longest)
    # The place in the tables, a symbol of a row, at every step.
    came = np.zeros((longest, count), dtype=symbols.place)
    known, row = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int32)
    models = _Models(count)
    for step, live in enumerate(lives):
        if live < len(models.last):
            models.shorten(live)
        now, rank = ids[step, :live], rest[step, :live]
        context = models.predict()
        right = now == models.known
        symbol = symbols.symbol_of.take(rank)
        fresh = np.flatnonzero(rank == 0)
        # A new id is spelt out, a rank counted from the least of its class.
        spelt = np.where(rank, rank - symbols.least_of.take(rank), now)
        hit = np.flatnonzero(right[0] | right[1])
        symbol[hit] = right[1].take(hit) ^ True
        spelt[hit] = 0
        rest[step, :live] = spelt
        context += row[:live]
        context *= symbols.count
        context += symbol
        came[step, :live] = context
        known[fresh] = met = known.take(fresh) + 1
        row[fresh] = symbols.row_of.take(met)
        models.learn(now, right)
    for step in range(0, longest, COUNTED):
        counts += np.bincount(came[step : step + COUNTED].ravel(), minlength=len(counts))
    parts = symbols.frequencies(counts)
    tables = _tables(parts)
    begins, parts = _begins(parts)
    digits = symbols.of_places(symbols.digits)
    # The words that have left, with the block of each.
    left: list[np.ndarray] = []
    blocks_left: list[np.ndarray] = []
    # Few binary digits are sorted by counting.
    lane = np.min_scalar_type(count)
    interval = _Interval(count)
    for step, live in enumerate(lives):
        low, width = interval.low[:live], interval.width[:live]
        what = came[step, :live].astype(np.int64)
        width >>= _SCALE
        low += width * begins.take(what)
        width *= parts.take(what)
        width >>= digits.take(what)
        low += width * rest[step, :live].astype(np.uint64)
        narrow = np.flatnonzero(width < _FULL)
        if len(narrow):
            left.append(interval.lead(narrow).astype(np.uint32))
            blocks_left.append(narrow.astype(lane))
    # The lower end of the last interval names it.
    every = np.arange(count, dtype=lane)
    left += [(interval.low >> _WORD).astype(np.uint32), (interval.low & _LOW).astype(np.uint32)]
    blocks_left += [every, every]
    owner = np.concatenate(blocks_left)
    words = np.concatenate(left)[np.argsort(owner, kind="stable")].astype("<u4")
    ends = np.cumsum(np.bincount(owner, minlength=count))
    for i, size, start, end in zip(order, sizes, np.append(0, ends), ends):
        if size:
            out[i] = words[start:end].tobytes()
    return out, tables


def _begins(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the part of every place begins in its row, and how wide it is."""
    begins = parts.cumsum(axis=1) - parts
    return begins.ravel().astype(np.uint64), parts.ravel().astype(np.uint64)


def _tables(parts: np.ndarray) -> bytes:
    return zlib.compress(parts.astype("<u2").tobytes())


def decode(
    codes: list[bytes], tables: bytes, sizes: list[int], id_bits: int, most_ids: int
) -> list[np.ndarray]:
    """The ids of every block, given how many there are, and what ``encode`` gave and got."""
    symbols = _Symbols(id_bits, most_ids)
    order, sizes_ = _arranged(sizes)
    count, longest = len(order), int(sizes_[0]) if order else 0
    if not longest:
        return [np.zeros(0, dtype=np.uint32) for _ in codes]
    parts = np.frombuffer(zlib.decompress(tables), dtype="<u2").astype(np.int64)
    parts = parts.reshape(symbols.rows, symbols.count)
    found = np.repeat(np.arange(parts.size, dtype=symbols.place), parts.ravel())
    begins, parts = _begins(parts)
    digits = symbols.of_places(symbols.digits)
    first_of = symbols.of_places(symbols.begins)
    is_new = symbols.of_places(np.arange(symbols.count) == NEW)
    # The words of all blocks in a row; a block that is read past its end meets the next.
    given = [np.frombuffer(codes[i], dtype="<u4") for i in order]
    words = np.concatenate([*given, np.zeros(2, dtype="<u4")]).astype(np.uint64)
    read = np.cumsum([0, *map(len, given)])[:-1]
    code = words[read] << _WORD | words[read + 1]
    read += 2
    last = len(words) - 1
    ids = np.zeros((longest, count), dtype=np.int32)
    # What the orders remember (rows 0 and 1); from row 2, the ids of every block in the order
    # of their first occurrence.
    seen = np.zeros((longest + 2, count), dtype=np.int32)
    known, row = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int32)
    every = np.arange(count, dtype=np.int64)
    models, interval = _Models(count), _Interval(count)
    for step, live in enumerate(_live(sizes_, longest)):
        if live < len(models.last):
            models.shorten(live)
        low, width, now = interval.low[:live], interval.width[:live], ids[step, :live]
        context = models.predict()
        seen[0, :live], seen[1, :live] = models.known[1], models.known[0]
        place = code[:live] - low
        width >>= _SCALE
        at = (place // width).view(np.int64)
        context += row[:live]
        context <<= SCALE
        at += context
        what = found.take(at).astype(np.int64)
        skipped = width * begins.take(what)
        low += skipped
        place -= skipped
        width *= parts.take(what)
        width >>= digits.take(what)
        place //= width
        low += width * place
        rest = place.view(np.int64)
        at = rest + first_of.take(what)
        at *= count
        at += every[:live]
        seen.take(at, mode="clip", out=now)
        fresh = np.flatnonzero(is_new.take(what))
        if len(fresh):
            new = rest.take(fresh)
            now[fresh] = new
            known[fresh] = met = known.take(fresh) + 1
            row[fresh] = symbols.row_of.take(met)
            seen[met + 1, fresh] = new
        narrow = np.flatnonzero(width < _FULL)
        if len(narrow):
            interval.lead(narrow)
            next_ = read.take(narrow)
            code[narrow] = code.take(narrow) << _WORD | words.take(np.minimum(next_, last))
            read[narrow] = next_ + 1
        models.learn(now, now == models.known)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(codes)
    for lane, i in enumerate(order):
        out[i] = ids[: sizes_[lane], lane].astype(np.uint32)
    return out
