"""CRC-32C of many byte strings at once in numpy, and its masked form of record files."""

import numpy as np

POLYNOMIAL = 0x82F63B78  # Castagnoli, reflected
BLOCK = 64
MASK_DELTA = 0xA282EAD8


def _byte_table():
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1).astype(np.uint32)
    return c


_BYTE = _byte_table()


def _place_tables():
    """Per place in a block: the share of each byte value in the block's checksum."""
    tables = np.empty((BLOCK, 256), np.uint32)
    tables[-1] = _BYTE
    for k in range(BLOCK - 2, -1, -1):
        tables[k] = _BYTE[tables[k + 1] & 255] ^ (tables[k + 1] >> 8)
    return tables


_PLACE = _place_tables()


def _apply(tables, c):
    return (
        tables[0][c & 255]
        ^ tables[1][(c >> 8) & 255]
        ^ tables[2][(c >> 16) & 255]
        ^ tables[3][c >> 24]
    )


def _block_shift():
    """Tables, per byte of a checksum, of moving it over one block of zeros."""
    tables = []
    for k in range(4):
        c = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK):
            c = _BYTE[c & 255] ^ (c >> 8)
        tables.append(c)
    return tables


_SHIFTS = [_block_shift()]


def _shift(level):
    """Tables of moving a checksum over 2^level blocks of zeros."""
    while len(_SHIFTS) <= level:
        _SHIFTS.append([_apply(_SHIFTS[-1], t) for t in _SHIFTS[-1]])
    return _SHIFTS[level]


def crc32c(strings):
    """CRC-32C of each of some byte strings of four bytes or more.

    The checksum is linear: zeros in front change nothing and a block's share moves over the blocks
    behind it by a fixed table. So strings are set flush right into rows of blocks, all blocks are
    summed at once, and neighbours are merged pairwise until one is left of each string.
    """
    if not strings:
        return np.zeros(0, np.uint32)
    sizes = np.array([len(s) for s in strings])
    if sizes.min() < 4:
        raise ValueError("strings of four bytes or more")
    counts = -(-sizes // BLOCK)
    ends = np.cumsum(counts) * BLOCK
    data = np.zeros(ends[-1], np.uint8)
    for s, end in zip(strings, ends.tolist()):
        data[end - len(s) : end] = np.frombuffer(s, np.uint8)
    head = (ends - sizes)[:, None] + np.arange(4)
    data[head] ^= 255  # the usual start value of all ones
    rows = data.reshape(-1, BLOCK)
    c = np.zeros(len(rows), np.uint32)
    for k in range(BLOCK):
        c ^= _PLACE[k][rows[:, k]]
    level = 0
    while counts.max() > 1:
        padded = counts + counts % 2
        begin = np.cumsum(padded) - padded
        old = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        even = np.zeros(padded.sum(), np.uint32)
        even[(begin + counts % 2)[owner] + np.arange(len(owner)) - old[owner]] = c
        c = _apply(_shift(level), even[0::2]) ^ even[1::2]
        counts, level = padded // 2, level + 1
    return c ^ np.uint32(0xFFFFFFFF)


def masked(c):
    """The checksum turned by 15 bits and shifted, so that checksums of checksums stay apart."""
    return ((c >> np.uint32(15)) | (c << np.uint32(17))) + np.uint32(MASK_DELTA)
