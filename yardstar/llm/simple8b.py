"""Simple-8b word-aligned coding of whole numbers, in numpy.

The upper four bits of each 64-bit word select how many numbers its other
sixty bits hold, and of what width. From four bits on, the value of all ones is
an escape: the number itself stands in a list of its own, so one large number
doesn't cost its neighbours their narrow fields.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the coding: numbers in a word and bits of each, by selector.
FIELDS = (
    (240, 0),
    (120, 0),
    (60, 1),
    (30, 2),
    (20, 3),
    (15, 4),
    (12, 5),
    (10, 6),
    (8, 7),
    (7, 8),
    (6, 10),
    (5, 12),
    (4, 15),
    (3, 20),
    (2, 30),
    (1, 60),
)
COUNT = np.array([count for count, _ in FIELDS])
ESCAPING_BITS = 4
SELECTOR_SHIFT = np.uint64(60)
COST = 1680  # of a word, a multiple of all counts that allow escapes and of the others
MOST_COST = (1 << 12) - 1


def _limit(bits: int) -> int:
    """The first number that a field of so many bits can't hold."""
    return (1 << bits) - (bits >= ESCAPING_BITS)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words, escapes)`` of unsigned numbers below ``2**64``.

    At each place the selector is taken that costs the fewest bits a number,
    escapes included. What it would cost is found for all places at once; only
    the steps from word to word are followed one by one.
    """
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # Values above 32 bits fit the last two widths alone, so the narrow ones are compared by halves of the memory.
    low = np.minimum(values, np.uint64(0xFFFFFFFF)).astype(np.uint32)
    best = np.full(n, 0xFFFF, np.uint16)  # cost of a number, and the selector in the lower four bits
    for s, (count, bits) in enumerate(FIELDS):
        misfit = (low >= np.uint32(_limit(bits))) if bits < 32 else values >= np.uint64(_limit(bits))
        n_misfits = np.count_nonzero(misfit)
        if bits < ESCAPING_BITS and n_misfits > n - min(n, count):
            continue  # no word of them is without a misfit
        before = np.zeros(n + count, np.uint8)  # modulo 256, as no word has more numbers
        np.cumsum(misfit.view(np.uint8), out=before[1 : n + 1])
        before[n + 1 :] = before[n]
        escapes = before[count:] - before[:n]
        its_cost = (escapes.astype(np.uint16) + np.uint16(1)) * np.uint16(COST // count)
        if count > 1:  # words at the end that are not filled
            tail = np.arange(max(n - count + 1, 0), n)
            its_cost[tail] = np.minimum((1 + escapes[tail].astype(np.int64)) * COST // (n - tail), MOST_COST)
        its_cost <<= np.uint16(4)
        its_cost |= np.uint16(s)
        if bits < ESCAPING_BITS:
            its_cost[escapes > 0] = 0xFFFF
        np.minimum(best, its_cost, out=best)
        if not n_misfits:
            break  # wider fields hold fewer numbers in a word
    selector = best & np.uint16(15)
    step = COUNT[selector].tolist()
    begins, at = [], 0
    while at < n:
        begins.append(at)
        at += step[at]
    begin = np.array(begins)
    chosen = selector[begin]
    words = chosen.astype(np.uint64) << SELECTOR_SHIFT
    padded = np.concatenate([values, np.zeros(COUNT.max(), np.uint64)])
    escaped = np.zeros(n, bool)
    for s in np.unique(chosen):
        count, bits = FIELDS[s]
        if not bits:
            continue
        rows = np.flatnonzero(chosen == s)
        places = begin[rows][:, None] + np.arange(count)
        fields = padded[places]
        if bits >= ESCAPING_BITS:
            large = fields >= np.uint64(_limit(bits))
            escaped[places[large]] = True
            fields[large] = np.uint64(_limit(bits))
        words[rows] |= np.bitwise_or.reduce(fields << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
    return words, values[escaped]


def decode(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` numbers: a gather for each selector, without a loop over words."""
    selector = (words >> SELECTOR_SHIFT).astype(np.int64)
    count_of = COUNT[selector]
    end = np.cumsum(count_of)
    begin = end - count_of
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint64)
    marks = []
    for s in np.unique(selector):
        count, bits = FIELDS[s]
        if not bits:
            continue
        rows = np.flatnonzero(selector == s)
        shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
        fields = (words[rows][:, None] >> shifts) & np.uint64((1 << bits) - 1)
        places = begin[rows][:, None] + np.arange(count)
        out[places] = fields
        if bits >= ESCAPING_BITS:
            marks.append(places[fields == np.uint64(_limit(bits))])
    if marks:
        out[np.sort(np.concatenate(marks))] = escapes
    return out[:n]
