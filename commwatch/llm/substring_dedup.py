"""Removal of repeated word windows, found by difference-cover anchors.

A window is ``WINDOW`` consecutive words. Equal windows at places i and j are found by hashing shorter
anchors, and these only at places whose remainder by ``PERIOD`` lies in ``COVER``. The cover holds
every difference modulo the period, so some shift below the period brings both i and j onto cover
places, and the anchors there lie inside both windows. Every repeated window hence has an anchor
that repeats, and less than a third of all places is hashed. Around the repeated anchors alone the
search then extends to whole windows and compares these.
"""

import hashlib
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commwatch.llm.arrow_text import (
    BASES, CHUNK_BYTES, chunks, flat, mix, signed, span_hashes, window_starts, word_hashes,
)
from commwatch.llm.storage import map_arrow

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)
# columns that stay the same from row to row come first, where compression finds them
PACKED = "t1 long, size int, id long, packed binary"
ANCHORS = "t1 long, size int, h long, pos int"
WINDOWS = "id long, t1 long, size int, w1 long, rest long, more int"
RESULT = "t1 long, size int, id long, n_words long, n_removed long, kept_sha256 string"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
LOWEST = -(2**63)


def _pack(batches):
    """Texts compressed before they are shuffled."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for chunk in chunks(batch):
            texts = chunk.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(chunk.column(c) for c in ("t1", "size", "id")), pa.array(map(pack, texts))],
                ["t1", "size", "id", "packed"],
            )


def _unpacked(batches):
    """Chunks of about ``CHUNK_BYTES`` of text, with their texts, of batches of packed ones."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        ends = np.cumsum(batch.column("size").to_numpy().astype(np.int64))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + CHUNK_BYTES, "right")))
            chunk = batch.slice(first, last - first)
            texts = pa.array(map(unpack, chunk.column("packed").to_pylist()), pa.large_binary())
            yield chunk, texts.view(pa.large_string())
            first = last


def _unlike(hashes, places):
    """Hashes that occur once, in place of hashes whose question is settled already."""
    return mix(hashes + mix(places.astype(np.uint64) + np.uint64(1)))


def _anchors(batches, window, period, cover):
    """Hashes at cover places. A place known to repeat is marked by a negative number.

    Of equal hashes in a chunk of texts only the first still has to meet the others elsewhere; the
    rest get hashes of their own, which spreads a passage of a third of all texts.
    """
    length = window - period + 1
    wanted = np.isin(np.arange(period), cover)
    for chunk, texts in _unpacked(batches):
        data, at = flat(texts)
        words, upto = word_hashes(data, at)
        start, owner = window_starts(upto, length)
        place = start - upto[owner]
        use = wanted[place % period] & (np.diff(upto)[owner] >= window)
        start, owner, place = start[use], owner[use], place[use]
        h = span_hashes(words, start, start + length, BASES[0])
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        later = order[1:][same]
        known = np.zeros(len(h), bool)
        known[later] = known[order[:-1][same]] = True
        h[later] = _unlike(h[later], start[later])
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("t1").take(pa.array(owner)),
                chunk.column("size").take(pa.array(owner)),
                pa.array(signed(h)),
                pa.array(np.where(known, -place - 1, place).astype(np.int32)),
            ],
            ["t1", "size", "h", "pos"],
        )


def _lists(column):
    """Values of a list column and the row of each."""
    column = column.fill_null([]) if column.null_count else column
    values = pc.list_flatten(column)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return values, np.repeat(np.arange(len(column)), sizes)


def _covered(n, first, last):
    """Which of n places lie in some range from ``first`` to ``last``, inclusive."""
    steps = np.bincount(first, minlength=n + 1) - np.bincount(last + 1, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0


def _windows(batches, window, period):
    """All windows around the repeated anchors, with hashes of 64 and 32 bits.

    Of equal windows in a chunk the earliest goes on to meet those elsewhere. The later ones are
    known to repeat and are told as ranges of starts, the first of which is negative. ``rest``
    holds the second hash above the start, ``more`` the number of further starts of a range.
    """
    for chunk, texts in _unpacked(batches):
        data, at = flat(texts)
        one, upto = word_hashes(data, at)
        two, _ = word_hashes(data, at, 1)
        values, row = _lists(chunk.column("anchors"))
        place = values.to_numpy(zero_copy_only=False).astype(np.int64)
        low = np.maximum(place - period + 1, 0) + upto[row]
        high = np.minimum(place, np.diff(upto)[row] - window) + upto[row]
        start = np.flatnonzero(_covered(len(one), low, high))
        owner = np.searchsorted(upto, start, "right") - 1
        w1 = span_hashes(one, start, start + window, BASES[0])
        w2 = span_hashes(two, start, start + window, BASES[1]) >> np.uint64(32)
        ids = chunk.column("id").to_numpy(zero_copy_only=False)[owner]
        place = start - upto[owner]
        order = np.lexsort((place, ids, w2, w1))
        a, b = order[1:], order[:-1]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (w1[a] != w1[b]) | (w2[a] != w2[b])
        head = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        later = np.zeros(len(order), bool)
        later[order] = (ids[order] != ids[head]) | (place[order] != place[head])
        kept, dup = np.flatnonzero(~later), np.flatnonzero(later)
        edge = np.ones(len(dup), bool)
        edge[1:] = (np.diff(start[dup]) != 1) | (np.diff(owner[dup]) != 0)
        runs, ends = dup[edge], dup[np.append(edge[1:], True)[: len(dup)]]
        own = pa.array(np.concatenate([owner[kept], owner[runs]]))
        told = np.concatenate([place[kept], -place[runs] - 1]).astype(np.int32)
        second = np.concatenate([w2[kept], w2[runs]]) << np.uint64(32)
        yield pa.RecordBatch.from_arrays(
            [
                *(chunk.column(c).take(own) for c in ("id", "t1", "size")),
                pa.array(signed(np.concatenate([w1[kept], _unlike(w1[runs], start[runs])]))),
                pa.array(signed(second | told.view(np.uint32).astype(np.uint64))),
                pa.array(
                    np.concatenate([np.zeros(len(kept)), place[ends] - place[runs]]).astype(np.int32)
                ),
            ],
            ["id", "t1", "size", "w1", "rest", "more"],
        )


def _remove(batches, window, with_text):
    for chunk, texts in _unpacked(batches):
        starts, row = _lists(chunk.column("starts"))
        first = starts.field("start").to_numpy(zero_copy_only=False).astype(np.int64)
        last = first + starts.field("more").to_numpy(zero_copy_only=False) + window - 1
        edges = np.searchsorted(row, np.arange(chunk.num_rows + 1))
        totals, gone, kept = [], [], []
        for k, text in enumerate(texts.cast(pa.large_binary()).to_pylist()):
            words, removed = text.split(), 0
            a, b = edges[k], edges[k + 1]
            totals.append(len(words))
            if b > a:
                stay = ~_covered(len(words), first[a:b], last[a:b])
                removed = len(words) - int(stay.sum())
                words = compress(words, stay.tolist())
            gone.append(removed)
            kept.append(b" ".join(words))
        columns = [
            *(chunk.column(c) for c in ("t1", "size", "id")),
            pa.array(totals, pa.int64()),
            pa.array(gone, pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
        ]
        names = ["t1", "size", "id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns.append(pa.array(kept).cast(pa.string()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(columns, names)


def remove_repeats(df, window=WINDOW, period=PERIOD, cover=COVER, with_text=False):
    """One row per document: its words, how many go and a hash of what stays.

    Words are runs of characters other than space and 0x09 to 0x0D. A word goes if it lies in a
    window of ``window`` words whose sequence also starts earlier: under a smaller ``doc_id``, or
    earlier in the same document. ``with_text`` adds the column ``kept``, the words that stay with
    one space between.

    Null text has no words, and a text with fewer words than a window loses none. Null keys count
    as one key before all others. Rows with equal keys count as one document in this order: at
    equal places neither is earlier, so repeated rows share one result. An empty table gives no
    rows. Other columns are not read.

    Exact copies are settled first: equal texts (by size and 64 bits of hash) become one row under their
    smallest key, before the shuffle where possible, and other copies lose all words. The texts are
    shuffled once; the three steps that read them share that exchange. Anchors, windows and their
    places are narrow rows. A passage that a third of all texts share is settled within each chunk
    of a task first, so the shuffle has at most one row of it per chunk.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = df.select(
        F.xxhash64(text).alias("t1"),
        F.octet_length(text).alias("size"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)).alias("id"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text.alias("text"),
    )
    key = ["t1", "size"]
    distinct = (
        map_arrow(keyed.drop("doc_id"), _pack, PACKED)
        # never null, but a join would ask; asked here, all steps have the same plan and exchange
        .where("t1 IS NOT NULL AND size IS NOT NULL")
        .groupBy(*key)
        .agg(F.min("id").alias("id"), F.first("packed").alias("packed"))
    )
    find = partial(_anchors, window=window, period=period, cover=cover)
    # all columns, so that this exchange is the one that the later steps reuse
    anchors = map_arrow(distinct, find, ANCHORS)
    repeated = anchors.withColumn("n", F.count("*").over(Window.partitionBy("h")))
    places = (
        repeated.where("n > 1 OR pos < 0")
        .groupBy(*key)
        .agg(F.collect_list(F.expr("if(pos < 0, -pos - 1, pos)")).alias("anchors"))
    )
    extend = partial(_windows, window=window, period=period)
    # dealt by the first hash alone, so that the second one need not be a column of its own
    windows = map_arrow(distinct.join(places, key), extend, WINDOWS).repartition("w1")
    windows = windows.withColumns(
        {
            "start": F.expr("cast(shiftright(shiftleft(rest, 32), 32) AS int)"),
            "w2": F.expr("shiftright(rest, 32)"),
        }
    )
    earliest = F.min(F.struct("id", "start")).over(Window.partitionBy("w1", "w2"))
    later = windows.withColumn("later", (F.col("start") < 0) | (F.struct("id", "start") > earliest))
    starts = (
        later.where("later")
        .groupBy(*key)
        .agg(
            F.collect_list(
                F.struct(F.expr("if(start < 0, -start - 1, start)").alias("start"), F.col("more"))
            ).alias("starts")
        )
    )
    cut = partial(_remove, window=window, with_text=with_text)
    schema = RESULT + (", kept string" if with_text else "")
    results = map_arrow(distinct.join(starts, key, "left"), cut, schema)
    rows = keyed.select(*key, "doc_id").join(results, key)
    copy = (F.coalesce("doc_id", F.lit(LOWEST)) != F.col("id")) & (F.col("n_words") >= window)
    kept = [F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")] if with_text else []
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        *kept,
    )
