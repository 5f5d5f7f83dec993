"""Token counts of whole texts; huge texts are encoded in overlapping chunks that are spliced.

A chunk overlaps the one before it. Both encodings of the overlap are compared by their offsets and
the texts are spliced at a boundary that the whole text's encoding has as well. What proves one:

- Byte-level BPE, a boundary between two pre-tokens in both encodings. The splitter's matches depend
  on nothing before them, so from there on the right chunk is split as the whole text is, and up to
  there the left chunk is, if its end is further away than the longest special string.
- Byte-level BPE where one pre-token covers the overlap, and sentencepiece: a boundary in both that
  the same token follows in both. Merges take the lowest rank first and then the leftmost pair, so
  the parts of a text at either side of a boundary never meet; whether two neighbours stay apart is
  therefore a matter of these two alone, and a row of tokens is the encoding of its text when all
  its neighbours are those of some encoding. In a sentencepiece text the boundary has to lie between
  plain characters, which normalisation leaves alone.

Where no boundary is proven the overlap is doubled, in the end up to the whole text. Vocabularies of
other kinds are given whole texts at once.
"""

import json
import os
import re
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from commwatch.llm.arrow_text import chunks
from commwatch.llm.storage import map_arrow

CHUNK = 100_000  # characters of a chunk beyond its overlap, and the longest text encoded at once
OVERLAP = 512
LIMIT = 512
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_CODECS = {}
_PLAIN_CUT = re.compile("(?<=[0-9A-Za-z])(?= ?[0-9A-Za-z])")


class Encoded:
    """Tokens of a chunk: where each starts and ends in the text, its id and its pre-token."""

    def __init__(self, offset, spans, ids, words=None):
        spans = np.array(spans, np.int64).reshape(-1, 2) + offset
        self.starts, self.ends = spans[:, 0], spans[:, 1]
        self.ids = np.array(ids, np.int64)
        self.words = words if words is None else np.array([-1 if w is None else w for w in words])

    def __len__(self):
        return len(self.ids)

    def boundaries(self, low, high):
        """Tokens that start between two places, exactly where the token before them ends."""
        at = np.arange(1, len(self))
        clean = (self.starts[1:] == self.ends[:-1]) & (self.starts[1:] > self.starts[:-1])
        return at[clean & (self.starts[1:] >= low) & (self.starts[1:] <= high)]

    def new_word(self, at):
        return self.words[at] != self.words[at - 1]

    def one_word(self, low, high):
        """Whether a single pre-token covers all between two places."""
        inside = self.words[(self.ends > low) & (self.starts < high)]
        return len(inside) > 0 and inside[0] >= 0 and (inside == inside[0]).all()


def _common(left, right, low, high):
    """Token numbers in both chunks of their common boundaries between two places."""
    a, b = left.boundaries(low, high), right.boundaries(low, high)
    _, i, j = np.intersect1d(left.starts[a], right.starts[b], assume_unique=True, return_indices=True)
    return a[i], b[j]


class ByteLevel:
    """A BPE file of the tokenizers library whose pre-tokens are those of a byte-level splitter."""

    def __init__(self, library, specials):
        self.library = library
        self.margin = max([4, *map(len, specials)])

    def counts(self, texts):
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text, offset):
        e = self.library.encode(text, add_special_tokens=False)
        return Encoded(offset, e.offsets, e.ids, e.word_ids)

    def meet(self, text, left, right, low, high):
        a, b = _common(left, right, low + 1, high - self.margin)
        same = left.ids[a] == right.ids[b]
        proven = same & left.new_word(a) & right.new_word(b)
        if not proven.any() and left.one_word(low, high) and right.one_word(low, high):
            proven = same
        found = np.flatnonzero(proven)
        return (a[found[-1]], b[found[-1]]) if len(found) else None


class Pieces:
    """A sentencepiece model of ranked merges."""

    margin = 4

    def __init__(self, library):
        self.library = library

    def counts(self, texts):
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]

    def encode(self, text, offset):
        pieces = self.library.encode(text, return_type="offset_mapping")
        return Encoded(offset, pieces["offsets"], pieces["ids"])

    def meet(self, text, left, right, low, high):
        a, b = _common(left, right, low + 1, high - self.margin)
        for i, j in zip(a[::-1].tolist(), b[::-1].tolist()):
            if left.ids[i] == right.ids[j] and _PLAIN_CUT.match(text, int(left.starts[i])):
                return i, j
        return None


class Whole:
    """Any other vocabulary: no text is cut."""

    encode = None

    def __init__(self, counts):
        self.counts = counts


def _splits_as_byte_level(settings):
    model, splitter = settings["model"], settings.get("pre_tokenizer") or {}
    affixes = ("continuing_subword_prefix", "end_of_word_suffix", "dropout")
    return (
        model["type"] == "BPE"
        and not any(model.get(a) for a in affixes)
        and settings.get("normalizer") is None
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in settings["added_tokens"])
    )


def _merges(library):
    """Whether a sentencepiece model is of ranked merges and not of token probabilities."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto.FromString(library.serialized_model_proto())
    return model.trainer_spec.model_type == model.trainer_spec.BPE


def codec(path):
    """The worker's codec of a vocabulary file, made once."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _CODECS:
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            pieces = Pieces(SentencePieceProcessor(model_file=path))
            _CODECS[path] = pieces if _merges(pieces.library) else Whole(pieces.counts)
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            with open(path, encoding="utf-8") as file:
                settings = json.load(file)
            exact = ByteLevel(library, [t["content"] for t in settings["added_tokens"]])
            _CODECS[path] = exact if _splits_as_byte_level(settings) else Whole(exact.counts)
    return _CODECS[path]


def spliced_count(text, by, chunk=CHUNK, overlap=OVERLAP):
    """Number of tokens of a text, encoded in chunks of ``chunk`` characters and their overlaps."""
    if by.encode is None or len(text) <= chunk:
        return by.counts([text])[0]
    base, end, first, total = 0, chunk, 0, 0
    left = by.encode(text[:end], 0)
    while end < len(text):
        begin = left.starts[first] if first < len(left) else base
        width, met = overlap, None
        while met is None and end - width > begin:
            low = end - width
            high = min(len(text), end + chunk)
            right = by.encode(text[low:high], low)
            met = by.meet(text, left, right, low, end)
            width *= 2
        if met is None:  # the overlap has grown to all of the left chunk: that one grows
            end = min(len(text), end + max(chunk, end - base))
            left = by.encode(text[base:end], base)
            continue
        total += int(met[0]) - first
        base, end, left, first = low, high, right, int(met[1])
    return total + len(left) - first


def _count(batches, path, limit, chunk, overlap):
    by = codec(path)
    for batch in batches:
        for part in chunks(batch):
            texts = pc.fill_null(part.column("text"), "")
            values = texts.to_pylist()
            short = [i for i, t in enumerate(values) if len(t) <= chunk]
            n = np.zeros(len(values), np.int64)
            n[short] = by.counts([values[i] for i in short])
            for i in set(range(len(values))).difference(short):
                n[i] = spliced_count(values[i], by, chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(n),
                    pa.array(n > limit),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )


def count_tokens(df, vocabulary, limit=LIMIT, chunk=CHUNK, overlap=OVERLAP):
    """One row per document: ``doc_id``, ``n_bytes``, ``n_tokens`` and whether these exceed ``limit``.

    ``vocabulary`` is a file of the tokenizers library (.json) or of sentencepiece (.model) that all
    executors can read. No special tokens are added; special strings inside a text are what the
    library makes of them. Nothing is truncated or padded.

    A null or empty text has no bytes and no tokens. Texts of more than ``chunk`` characters are
    encoded in overlapping chunks, one at a time, so that memory is bounded by a text and one
    chunk's tokens; their counts are those of whole texts. Null and repeated keys, ties and repeated
    rows are rows like any other, an empty table gives no rows, other columns are not read. Nothing
    is shuffled.
    """
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    run = partial(_count, path=vocabulary, limit=limit, chunk=chunk, overlap=overlap)
    return map_arrow(rows, run, COUNTS)
