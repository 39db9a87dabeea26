"""Simple-8b: as many integers as fit in a 64-bit word, four bits of which say how many and how wide.

Values are cut into lanes of ``LANE`` values that are packed on their own, so that all lanes of a
block are packed, and later unpacked, together in numpy. A block is

    magic, number of values, of lanes, of words, of escapes   (5 x u64)
    first word of each lane                                   (lanes x u32)
    words                                                     (words x u64)
    place and value of each escape                            (escapes x 2 x u64)

little-endian. A value of 2**60 or more does not fit in a word: a zero stands at its place and the
value is in the escapes.
"""

from __future__ import annotations

import numpy as np

MAGIC = 0x3142_3853_4C4D_4B50
LANE = 512
#: Values and bits per value of each selector, the standard ones of the scheme.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)


def _widths(values: np.ndarray) -> np.ndarray:
    top = int(values.max(initial=0))
    if top < len(_SMALL):
        return _SMALL.take(values.astype(np.int64))
    return _compared(values, top)


def _compared(values: np.ndarray, top: int) -> np.ndarray:
    width = np.zeros(values.shape, np.uint8)
    if top < 1 << 32:
        values = values.astype(np.uint32)
    for bits in sorted(set(BITS.tolist())):
        if top >> bits == 0:
            break
        np.copyto(width, bits + 1, where=values >= values.dtype.type(1 << bits))
    return width  # at least one more than each selector's bits that are too few


#: The widths of values below 2**16.
_SMALL = _compared(np.arange(1 << 16), (1 << 16) - 1)


def _selectors(width: np.ndarray) -> np.ndarray:
    """The selector with the most values that fit, for a word that would begin at each place of each lane."""
    tables, length = {1: width}, 1
    while 2 * length <= COUNTS[0]:
        last, wider = tables[length], tables[length].copy()
        wider[:, :-length] = np.maximum(last[:, :-length], last[:, length:])
        tables[2 * length], length = wider, 2 * length
    best = np.full(width.shape, len(COUNTS) - 1, np.uint8)
    for selector in range(len(COUNTS) - 2, -1, -1):
        count, bits = int(COUNTS[selector]), BITS[selector]
        power = 1 << (count.bit_length() - 1)
        highest, shift = tables[power], count - power
        if shift:
            later = highest.copy()
            later[:, :-shift] = highest[:, shift:]
            highest = np.maximum(highest, later)
        np.copyto(best, selector, where=highest <= bits)
    return best


def _word_starts(selectors: np.ndarray) -> np.ndarray:
    """Where words begin if each starts behind the one before, as ascending places in lanes of one place more, their end.

    The first words are known; a step of twice as many words, from all that are known, finds as many again.
    """
    lanes = len(selectors)
    ahead = np.full((lanes, LANE + 1), LANE, np.int32)
    np.minimum(COUNTS.astype(np.int32)[selectors] + np.arange(LANE, dtype=np.int32), LANE, out=ahead[:, :LANE])
    first = np.arange(lanes, dtype=np.int32)[:, None] * (LANE + 1)
    ahead = (ahead + first).ravel()
    known = [first.ravel()]
    while len(found := ahead[np.concatenate(known)]) and (found % (LANE + 1) != LANE).any():
        known.append(found)
        ahead = ahead[ahead]
    reached = np.zeros(len(ahead), bool)
    reached[np.concatenate(known)] = True
    return np.flatnonzero(reached)


def pack(values: np.ndarray) -> bytes:
    """One block for any number of unsigned integers below 2**64."""
    values = np.asarray(values, np.uint64)
    escaped = np.flatnonzero(values >> np.uint64(60))
    lanes = -(-len(values) // LANE)
    grid = np.zeros((lanes, LANE + int(COUNTS[0])), np.uint64)
    filled = np.zeros(lanes * LANE, np.uint64)
    filled[: len(values)] = values
    filled[escaped] = 0
    grid[:, :LANE] = filled.reshape(lanes, LANE)
    sizes = np.full(lanes, LANE)
    if lanes:
        sizes[-1] = len(values) - (lanes - 1) * LANE
    selectors = _selectors(_widths(grid))[:, :LANE]
    place = _word_starts(selectors)
    lane, place = np.divmod(place[place % (LANE + 1) < sizes[place // (LANE + 1)]], LANE + 1)
    chosen = selectors[lane, place].astype(np.int64)
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        if BITS[selector]:
            rows = np.flatnonzero(chosen == selector)
            for k in range(COUNTS[selector]):
                words[rows] |= grid[lane[rows], place[rows] + k] << np.uint64(k * BITS[selector])
    firsts = np.searchsorted(lane, np.arange(lanes)).astype("<u4")
    head = np.array([MAGIC, len(values), lanes, len(words), len(escaped)], "<u8")
    extra = np.stack([escaped.astype("<u8"), values[escaped].astype("<u8")], axis=1)
    return b"".join(x.tobytes() for x in (head, firsts, words.astype("<u8"), extra))


def unpack(block: bytes) -> np.ndarray:
    """The values of a block, as unsigned 64-bit integers."""
    magic, count, lanes, size, escapes = (int(x) for x in np.frombuffer(block, "<u8", 5))
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    firsts = np.frombuffer(block, "<u4", lanes, 40).astype(np.int64)
    words = np.frombuffer(block, "<u8", size, 40 + 4 * lanes)
    extra = np.frombuffer(block, "<u8", 2 * escapes, 40 + 4 * lanes + 8 * size).reshape(-1, 2)
    chosen = (words >> np.uint64(60)).astype(np.int64)
    out = np.zeros(lanes * LANE + int(COUNTS[0]), np.uint64)
    ends = np.cumsum(COUNTS[chosen])
    lane = np.repeat(np.arange(lanes), np.diff(np.append(firsts, size)))
    before = np.append(0, ends)
    at = before[:-1] - before[firsts][lane]
    for selector in np.unique(chosen):
        if BITS[selector]:
            rows = np.flatnonzero(chosen == selector)
            mask = np.uint64((1 << int(BITS[selector])) - 1)
            for k in range(COUNTS[selector]):
                inside = at[rows] + k < LANE
                kept = rows[inside]
                out[lane[kept] * LANE + at[kept] + k] = (words[kept] >> np.uint64(k * BITS[selector])) & mask
    out = out[:count]
    out[extra[:, 0].astype(np.int64)] = extra[:, 1]
    return out
