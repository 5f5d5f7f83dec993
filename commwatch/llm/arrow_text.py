"""Arrow text columns as flat numpy arrays: words, their hashes and hashes of word windows.

Everything is computed on the concatenated UTF-8 bytes of a chunk of texts, without a Python object
per word. Words are runs of bytes other than space and the five marks of 0x09 to 0x0D.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so that powers have inverses
_POWERS = {}


def chunks(batch, *texts, most=CHUNK_BYTES):
    """Consecutive slices of a record batch with about ``most`` bytes of text, a row at least."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for text in texts or ("text",):
        length = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        sizes += length.to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(sizes), 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def flat(column):
    """The bytes of all texts, one after the other, and the offset at which each begins and ends."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def lower_ascii(data):
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def not_space(data):
    return (data != 32) & ((data < 9) | (data > 13))


def alphanumeric(data):
    """ASCII letters and digits, and all bytes of other letters and signs."""
    low = data | 32
    return ((low >= 97) & (low <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)


def runs(inside, at):
    """First byte and end of each run of true bytes; a run ends with its text."""
    n = len(inside)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < n)]  # a text ends where the next one begins, even inside a run
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words(data, at, inside=not_space):
    """First byte and end of each word, and the number of words before each text and in all."""
    first, last = runs(inside(data), at)
    return first, last, np.searchsorted(first, at)


def mix(x):
    """A bijection on 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base, n):
    """``base`` to the power 0 to n - 1 modulo 2^64, and the inverses of these."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 20)
        inverse = pow(base, -1, 1 << 64)
        made = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = tuple(made)
        if size <= 1 << 23:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def span_hashes(values, first, last, base):
    """64-bit hash of ``values[first:last]`` for all spans at once, by one running sum."""
    power, inverse = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=total[1:])
    length = (last - first).astype(np.uint64)
    return mix((total[last] - total[first]) * inverse[first] + length * np.uint64(BASES[1]))


def word_hashes(data, at, seed=0, inside=not_space):
    """Hash of each word, and the number of words before each text and in all."""
    first, last, upto = words(data, at, inside)
    return span_hashes(data, first, last, BASES[seed]), upto


def window_starts(upto, width):
    """Indexes of all words that begin ``width`` words of one text, and that text's number."""
    counts = np.maximum(np.diff(upto) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - before[owner] + upto[:-1][owner], owner


def signed(x):
    return x.view(np.int64)
