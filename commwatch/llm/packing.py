"""Hierarchical packing of documents into sequences of several lengths."""

import bisect
import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from commwatch.llm.arrow_text import chunks
from commwatch.llm.encoding import encoder
from commwatch.llm.storage import map_arrow

TIERS = (256, 512, 1024, 2048)
BLOCK_TOKENS = 4_000_000
STEP_TOKENS = 131_072
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier long, step_group long"
)


class _Pool:
    """Pieces of documents by length, with the longest that fits a gap found in one step."""

    def __init__(self, longest):
        self.by_length, self.present = [[] for _ in range(longest + 1)], 0

    def put(self, document, start, length):
        self.by_length[length].append((document, start))
        self.present |= 1 << length

    def _take(self, length):
        found = self.by_length[length].pop()
        if not self.by_length[length]:
            self.present &= ~(1 << length)
        return (*found, length)

    def longest(self, most):
        fits = self.present & ((1 << (most + 1)) - 1)
        return self._take(fits.bit_length() - 1) if fits else None

    def shortest(self):
        return self._take((self.present & -self.present).bit_length() - 1)


def tier_of(length, tiers):
    return tiers[bisect.bisect_left(tiers, length)]


def pack(lengths, tiers=TIERS):
    """Sequences as ``(tier, [(document, start, length), ...])`` of documents of given lengths.

    Documents longer than the last tier give full windows and a rest. Each rest is routed to the
    shortest tier that holds it. Tiers are packed from the longest down: a window starts with the
    longest piece left and its gap takes, again and again, the longest piece that still fits, which
    comes from a shorter tier. Where none fits, the shortest piece is cut to close the gap. So all
    windows are full but the last, which is cut into windows of falling powers of two: these, and
    only these, may be shorter than the first tier. No sequence has any padding.
    """
    pool, longest = _Pool(tiers[-1]), tiers[-1]
    for document, length in enumerate(lengths):
        full = length // longest
        for k in range(full):
            yield longest, [(document, k * longest, longest)]
        if length % longest:
            pool.put(document, full * longest, length % longest)
    while pool.present:
        first = pool.longest(longest)
        tier = tier_of(first[2], tiers)
        window, gap = [first], tier - first[2]
        while gap and pool.present:
            piece = pool.longest(gap)
            if piece is None:
                document, start, length = pool.shortest()
                piece = (document, start, gap)
                pool.put(document, start + gap, length - gap)
            window.append(piece)
            gap -= piece[2]
        if not gap:
            yield tier, window
            continue
        left = sum(length for _, _, length in window)
        while left:
            room = 1 << (left.bit_length() - 1)
            size, part = room, []
            while room:
                document, start, length = window.pop(0)
                cut = min(room, length)
                part.append((document, start, cut))
                if cut < length:
                    window.insert(0, (document, start + cut, length - cut))
                room -= cut
            yield size, part
            left -= size


def step_groups(sequences, step_tokens=STEP_TOKENS):
    """A step group for each sequence, so that groups of a block cost about the same.

    A sequence costs its tokens and the pairs that attention compares inside its pieces. The
    costliest sequences are dealt first, each to the group with the least cost so far that still
    has room, so steps on different machines end together.
    """
    import heapq

    cost = [sum(n * (1 + n / 4096) for _, _, n in pieces) for _, pieces in sequences]
    total = sum(size for size, _ in sequences)
    groups = [(0.0, g) for g in range(max(1, -(-total // step_tokens)))]
    chosen = [0] * len(sequences)
    for k in sorted(range(len(sequences)), key=lambda k: -cost[k]):
        load, g = heapq.heappop(groups)
        chosen[k] = g
        heapq.heappush(groups, (load + cost[k], g))
    return chosen, max(1, -(-total // step_tokens))


def _pack_block(keys, ids, width, tiers, step_tokens, number, group):
    """Rows of one block, the next free sequence number and the next free step group."""
    lengths = [len(b) // width for b in ids]
    sequences = list(pack(lengths, tiers))
    chosen, count = step_groups(sequences, step_tokens)
    rows = []
    for (tier, pieces), g in zip(sequences, chosen):
        offset = 0
        for d, start, length in pieces:
            part = np.frombuffer(ids[d], f"<u{width}", length, start * width).astype("<u4")
            rows.append((keys[d], start, length, zlib.crc32(part.tobytes()), lengths[d], number,
                         offset, tier, group + g))
            offset += length
        number += 1
    names = [c.split()[0] for c in PIECES.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(names)
    made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
    return made, number, group + count


def _pack(batches, vocabulary, end_id, tiers, block_tokens, step_tokens):
    codec = encoder(vocabulary)
    width, end = codec.dtype.itemsize, np.array([end_id], codec.dtype).tobytes()
    number = group = TaskContext.get().partitionId() << 32
    keys, ids, held = [], [], 0
    for batch in batches:
        for piece in chunks(batch):
            for key, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                keys.append(key)
                ids.append(codec.encode(text or "") + end)
                held += len(ids[-1]) // width
                if held >= block_tokens:
                    made, number, group = _pack_block(keys, ids, width, tiers, step_tokens, number, group)
                    yield made
                    keys, ids, held = [], [], 0
    if keys:
        yield _pack_block(keys, ids, width, tiers, step_tokens, number, group)[0]


def pack_documents(df, vocabulary, end_id=1, tiers=TIERS, block_tokens=BLOCK_TOKENS,
                   step_tokens=STEP_TOKENS):
    """One row per piece of a document: its place in the document and in a sequence.

    Columns: ``doc_id``, ``start`` and ``length`` in the document's ids, ``ids_crc32`` of the
    piece, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, ``tier`` (the sequence's
    length) and ``step_group``. Tiers are rising powers of two. The end id follows every document.

    Null text counts as empty, which leaves the end id. Repeated rows are packed one by one. An
    empty table gives no rows; other columns are not read.

    No shuffle: each task packs blocks of what it scans, about ``block_tokens`` ids at a time, so
    memory is bounded and keys or sources do not matter. Only a block's last window is cut short,
    into powers of two, so blocks cost no padding. Sequence numbers hold the task's number and a
    count, both the same when a task is run again.
    """
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers)):
        raise ValueError("tiers are rising powers of two")
    run = partial(_pack, vocabulary=vocabulary, end_id=end_id, tiers=tuple(tiers),
                  block_tokens=block_tokens, step_tokens=step_tokens)
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_arrow(rows, run, PIECES, encodes=True)
