"""Words of UTF-8 texts and their 64-bit hashes, found on whole byte arrays."""

import numpy as np
import pyarrow as pa

ONE_BYTES = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD1342543DE82EF95)
GAMMA = np.uint64(0xBF58476D1CE4E5B9)
DELTA = np.uint64(0x94D049BB133111EB)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def mixed(x):
    """A bijection of 64-bit numbers that spreads every bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * GAMMA
    x = (x ^ (x >> np.uint64(27))) * DELTA
    return x ^ (x >> np.uint64(31))


def byte_values():
    """A random-looking 64-bit number for each byte."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * ONE_BYTES)


def utf8(array):
    """The bytes of an Arrow string array and the bounds of its texts; null is empty."""
    if array.null_count:
        array = array.fill_null("")
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, kind, len(array) + 1 + array.offset)[array.offset :]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data, bounds.astype(np.int64)


def blocks(bounds, limit):
    """Ranges of texts of at most ``limit`` bytes, or of one longer text."""
    low, n = 0, len(bounds) - 1
    while low < n:
        high = int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high
        low = high


def plain_word_bytes():
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased text."""
    kept = np.zeros(256, bool)
    kept[0x30:0x3A] = kept[0x61:0x7B] = kept[0x80:] = True
    return kept


def spaced_word_bytes():
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    kept = np.ones(256, bool)
    kept[0x20] = kept[0x09:0x0E] = False
    return kept


class WordReader:
    """Finds the words of a block of texts, with A-Z lower-cased."""

    def __init__(self, word_bytes):
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[0x41:0x5B] += 32
        self.inside = word_bytes[self.lower]
        self.values = byte_values()[self.lower]
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n):
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            back = np.uint64(pow(int(BASE), -1, 1 << 64))
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, BASE)]))
                self.inverse = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, back)]))

    def read(self, data, bounds):
        """First and end byte of every word, its text's number, and its hash."""
        base = bounds[0]
        data, bounds = data[base : bounds[-1]], bounds - base
        inside = self.inside[data]
        breaks = np.zeros(len(data) + 1, bool)
        breaks[bounds] = True
        before = np.concatenate([[False], inside[:-1]]) & ~breaks[:-1] if len(data) else inside
        after = np.concatenate([inside[1:], [False]]) & ~breaks[1:] if len(data) else inside
        first = np.flatnonzero(inside & ~before)
        end = np.flatnonzero(inside & ~after) + 1
        of = np.searchsorted(bounds, first, "right") - 1
        self._grow(len(data) + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[data] * self.powers[: len(data)])])
            hashes = mixed((sums[end] - sums[first]) * self.inverse[first] + (end - first).astype(np.uint64))
        return first + base, end + base, of, hashes


def run_hashes(hashes, of, k):
    """The hash of the ``k`` words from each on; ``NONE`` where the text has fewer."""
    n = len(hashes)
    out = np.full(n, NONE)
    if n >= k:
        with np.errstate(over="ignore"):
            total = np.zeros(n - k + 1, np.uint64)
            for i in range(k):
                total = (total + hashes[i : n - k + 1 + i]) * BASE
            total = mixed(total + np.uint64(k))
        total[total == NONE] = np.uint64(0)
        out[: n - k + 1] = np.where(of[: n - k + 1] == of[k - 1 :], total, NONE)
    return out


def window_minima(values, w):
    """The smallest of the ``w`` values from each place on, as far as there are any."""
    out, have = values.copy(), 1
    while have < w:
        step = min(have, w - have)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out
