"""Token ids as length-delimited binary records with masked checksums and an offset index.

A data file is a run of frames, as record readers of training frameworks expect them:

    length of the payload   uint64, little-endian
    masked CRC-32C of those eight bytes   uint32
    payload
    masked CRC-32C of the payload   uint32

A payload is one document: a byte that is 1 if the document has an id, the id as int64, and the token
ids of 16 bits where the vocabulary has no more than 65,536 entries, else of 32. Beside each data
file lies its index: per record the offset of the frame, the payload's length and the number of
token ids before it in the file, so that any record can be read alone and in any order.
"""

import struct
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commwatch.llm.arrow_text import chunks
from commwatch.llm.checksums import crc32c, masked
from commwatch.llm.encoding import encoder, ids_crc32
from commwatch.llm.storage import map_arrow, store_of, stored
from commwatch.session import shared_dir

INDEX = np.dtype([("offset", "<u8"), ("length", "<u8"), ("before", "<u8")])
HEAD = struct.Struct("<bq")
MANIFEST = "part int, file string, records long, ids long, bytes long, width int"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
READ_BYTES = 8 << 20


class RecordError(ValueError):
    """A frame whose length or checksum does not fit."""


def frames(payloads):
    """The frames of some payloads, as byte strings."""
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    marks = zip(
        lengths,
        masked(crc32c(lengths)).tolist(),
        payloads,
        masked(crc32c(payloads)).tolist(),
    )
    return [n + struct.pack("<I", a) + p + struct.pack("<I", b) for n, a, p, b in marks]


def payloads_of(data, lengths):
    """The payloads of consecutive frames of known payload lengths; checks all four fields."""
    found, heads, marks, at = [], [], [], 0
    for n in lengths:
        frame = data[at : at + n + 16]
        if len(frame) < n + 16 or struct.unpack_from("<Q", frame)[0] != n:
            raise RecordError("a frame's length does not fit")
        heads.append(frame[:8])
        found.append(frame[12 : 12 + n])
        marks.append((struct.unpack_from("<I", frame, 8)[0], struct.unpack_from("<I", frame, 12 + n)[0]))
        at += n + 16
    if marks:
        a, b = np.array(marks, np.uint32).T
        if (a != masked(crc32c(heads))).any() or (b != masked(crc32c(found))).any():
            raise RecordError("a frame's checksum does not fit")
    return found


def _write(batches, folder, vocabulary, end_id):
    context = TaskContext.get()
    part, name = context.partitionId(), None
    codec = encoder(vocabulary)
    end = np.array([end_id], codec.dtype).tobytes()
    store, path = store_of(folder)
    index, offset, before = [], 0, 0
    out = None
    try:
        for batch in batches:
            for piece in chunks(batch):
                if out is None:
                    # tried again, a task writes under another name; the manifest has what counts
                    name = f"{part:06d}-{context.taskAttemptId()}"
                    out = store.open_output_stream(f"{path}/{name}.records")
                payloads = []
                for key, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    ids = codec.encode(text or "") + end
                    payloads.append(HEAD.pack(key is not None, key or 0) + ids)
                for frame in frames(payloads):
                    out.write(frame)
                    size = len(frame) - 16
                    index.append((offset, size, before))
                    offset += size + 16
                    before += (size - HEAD.size) // codec.dtype.itemsize
    finally:
        if out is not None:
            out.close()
    if name:
        with store.open_output_stream(f"{path}/{name}.index") as f:
            f.write(np.array(index, INDEX).tobytes())
        row = (part, name, len(index), before, offset, codec.dtype.itemsize)
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("part", "file", "records", "ids", "bytes", "width"), row))],
            pa.schema([("part", pa.int32()), ("file", pa.string()), ("records", pa.int64()),
                       ("ids", pa.int64()), ("bytes", pa.int64()), ("width", pa.int32())]),
        )


def write_records(df, folder, vocabulary, end_id=0):
    """Encode every text, write record files in ascending key order and return their manifest.

    ``df`` has ``doc_id`` and ``text``; other columns are not read. Null text encodes as empty, so
    its record has the end id alone. Null keys come first. Equal keys follow each other by a hash
    of the text. An empty table writes no file.

    One shuffle, of the texts, by range. The key, the text's hash and a number that parts equal
    rows make up the range key, so that a key on a third of all rows fills several files. A task
    streams its range into one file and keeps 24 bytes per record for the index. The manifest,
    committed by Spark, names the files of the tasks that counted; a lost or repeated task leaves
    at most an unnamed file.
    """
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    rows = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text"),
        F.xxhash64("text").alias("h"),
        F.monotonically_increasing_id().alias("m"),
    )
    dealt = rows.repartitionByRange("doc_id", "h", "m").sortWithinPartitions("doc_id", "h", "m")
    write = partial(_write, folder=folder, vocabulary=vocabulary, end_id=end_id)
    told = map_arrow(dealt.select("doc_id", "text"), write, MANIFEST, encodes=True)
    return stored(told, "manifest")


def read_index(store, path, name):
    with store.open_input_file(f"{path}/{name}.index") as f:
        return np.frombuffer(f.read(), INDEX)


def read_some(folder, name, places):
    """Payloads of one file's records at the given places, in that order: the shuffled read."""
    store, path = store_of(folder)
    index = read_index(store, path, name)
    with store.open_input_file(f"{path}/{name}.records") as f:
        return [
            payloads_of(f.read_at(int(n) + 16, int(o)), [int(n)])[0]
            for o, n in index[list(places)][["offset", "length"]].tolist()
        ]


def _read(batches, folder):
    store, path = store_of(folder)
    for batch in batches:
        for file in batch.to_pylist():
            dtype = np.dtype(f"<u{file['width']}")
            index = read_index(store, path, file["file"])
            if len(index) != file["records"]:
                raise RecordError("an index does not fit its manifest")
            lengths, first = index["length"].astype(np.int64), 0
            ends = np.cumsum(lengths + 16)
            with store.open_input_file(f"{path}/{file['file']}.records") as f:
                while first < len(index):
                    done = int(ends[first - 1]) if first else 0
                    last = max(first + 1, int(np.searchsorted(ends, done + READ_BYTES, "right")))
                    data = f.read_at(int(ends[last - 1]) - done, done)
                    rows = []
                    for k, p in zip(range(first, last), payloads_of(data, lengths[first:last].tolist())):
                        known, key = HEAD.unpack_from(p)
                        ids = p[HEAD.size :]
                        start = file["before"] + int(index["before"][k])
                        rows.append((key if known else None, start, len(ids) // dtype.itemsize,
                                     ids_crc32(ids, dtype)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*rows)],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    first = last


def read_records(manifest, folder):
    """One row per record, read from the files and checked: key, start, ids, their checksum.

    ``start`` counts the ids of all records before it in all files. The running sum of the
    manifest covers a row per file. Each file is a task's work.
    """
    upto = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("before", F.coalesce(upto, F.lit(0)))
    tasks = max(1, manifest.count())
    return map_arrow(files.repartition(tasks, "part"), partial(_read, folder=folder), ROWS)


def token_records(df, vocabulary, end_id=0, folder=None):
    """Write the record files of ``df`` and read them back, one row per document."""
    folder = folder or shared_dir(df.sparkSession, "records")
    return read_records(write_records(df, folder, vocabulary, end_id), folder)
