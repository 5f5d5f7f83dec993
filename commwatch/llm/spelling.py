"""Spelling variants grouped by products of letter-count blocks.

Words are dealt into blocks of one length and one coarse letter count, the number of their letters in
each of a few groups of letters. One inserted, deleted or replaced letter changes the letter counts by
a squared distance of one or two, so it leads from a block to itself or to one of its few neighbours:
those with a letter moved from one group to another, and those of the next length with a letter more.
Each pair of neighbouring blocks is one numpy product of their letter counts (Gram matrix), which gives
the squared distances of all its words. Pairs at most two apart are then verified letter by letter.
"""

import math
import zlib
from collections import Counter
from functools import partial
from itertools import chain, combinations, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from commwatch.llm.arrow_text import chunks, flat
from commwatch.llm.storage import map_arrow, stored

BLOCK_WORDS = 1024
MANY_WORDS = 200_000  # distinct words that a task holds before it passes their counts on
LETTERS_AT_ONCE = 1 << 22
# A random share per letter group; the sum over a word's letters tells its coarse letter count. More
# words take more groups, four times as many one more, which keeps blocks at some hundreds of words.
SHARES = (
    1_364_790_217, 729_163_849, 2_038_445_653, 1_691_007_431,
    318_904_771, 1_102_567_939, 1_873_320_017, 905_411_283,
)
BLOCKS = "block long, length int, key long, letters binary, n binary"
NEAR = "word string, n_near long, best_n long, best string"


def _letters(data):
    """Which bytes belong to letters A to Z, a to z and U+00C0 to U+00FF."""
    low = data | 32
    lead = data == 0xC3
    inside = ((low >= 97) & (low <= 122) & (data < 128)) | lead
    inside[1:] |= lead[:-1]
    return inside


def _counted(batches, damage):
    total = Counter()

    def told():
        words = [w.decode() for w in total]
        counts = pa.array(list(total.values()), pa.int64())
        total.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), counts], ["word", "n"])

    for batch in batches:
        for chunk in chunks(batch):
            data, at = flat(chunk.column("text"))
            text = np.where(_letters(data), data, 32).astype(np.uint8).tobytes().lower()
            for key, begin, end in zip(chunk.column("doc_id").to_pylist(), at[:-1], at[1:]):
                before = zlib.crc32(b"%s:" % (b"" if key is None else str(key).encode()))
                for word, n in Counter(text[begin:end].split()).items():
                    h = zlib.crc32(word, before)
                    if damage and h % damage == 0:
                        letters = word.decode()
                        gap = h % len(letters)
                        word = (letters[:gap] + letters[gap + 1 :]).encode()
                    total[word] += n
            if len(total) >= MANY_WORDS:
                yield told()
    if total:
        yield told()


def document_words(df, damage=None, shortest=5, rarest=3):
    """Distinct words ``(word, n)`` of all texts with ``shortest`` letters and ``rarest`` occurrences.

    A word is a maximal run of A to Z, a to z and U+00C0 to U+00FF; A to Z become lower case. With
    ``damage`` a word loses one letter wherever the CRC-32 of ``<doc_id>:<word>`` is divisible by it,
    the one at the place that the checksum gives (a null key counts as no digits).
    """
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    words = map_arrow(rows, partial(_counted, damage=damage), "word string, n long")
    words = words.where(F.char_length("word") >= shortest)
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rarest)


def _codes(text):
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _words(letters):
    return [bytes(row).decode("utf-32-le", "surrogatepass") for row in letters]


def groups_for(words):
    """Number of letter groups for a number of words."""
    return min(len(SHARES), max(3, math.ceil(math.log(max(words, 1) / 500, 4))))


def _keyed(batches, groups):
    """Length and coarse letter count of each word."""
    shares = np.array(SHARES[:groups], np.int64)
    for batch in batches:
        words = batch.column("word").to_pylist()
        length = np.array([len(w) for w in words], np.int64)
        share = shares[_codes("".join(words)) % groups]
        upto = np.concatenate([[0], np.cumsum(share)])
        end = np.cumsum(length)
        key = upto[end] - upto[end - length]
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), pa.array(length.astype(np.int32)), pa.array(key)],
            ["word", "n", "length", "key"],
        )


def _cut(batches, most):
    """Blocks of at most ``most`` neighbouring words of one length and key, in sorted rows."""
    numbers = count(TaskContext.get().partitionId() << 32)
    held = None

    def told(rows):
        length, key, words, n = rows
        letters = _codes("".join(words)).tobytes()
        return next(numbers), length, key, letters, np.array(n, np.int64).tobytes()

    def packed(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), _BLOCK_TYPES)], _BLOCK_NAMES
        )

    for batch in batches:
        done = []
        rows = (batch.column(c).to_pylist() for c in ("word", "n", "length", "key"))
        for word, n, length, key in zip(*rows):
            if held is None or (length, key) != held[:2] or len(held[2]) >= most:
                if held:
                    done.append(told(held))
                held = (length, key, [], [])
            held[2].append(word)
            held[3].append(n)
        if done:
            yield packed(done)
    if held:
        yield packed([told(held)])


_BLOCK_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
_BLOCK_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())


def _one_replaced(a, b):
    return (a != b).sum(1) == 1


def _one_inserted(a, b):
    """Whether the longer word is the shorter one and a letter more."""
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= a.shape[1]


def near_pairs(a, b, itself=False):
    """Index pairs of words one edit apart, in two blocks of code points.

    The words of the second are as long as those of the first, or a letter longer.
    """
    letters, column = np.unique(np.concatenate([a.ravel(), b.ravel()]), return_inverse=True)
    exact = np.float32 if b.shape[1] < 1000 else np.float64

    def counts(column, rows):
        at = np.repeat(np.arange(rows), len(column) // rows) * len(letters) + column
        return np.bincount(at, minlength=rows * len(letters)).reshape(rows, -1).astype(exact)

    x, y = counts(column[: a.size], len(a)), counts(column[a.size :], len(b))
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)
    longer = b.shape[1] - a.shape[1]
    # an insertion is one apart and a replacement two; anagrams, none apart, are no single edit
    at = np.flatnonzero((distance <= 2) & (distance == 2 - longer))
    i, j = at // len(b), at % len(b)
    if itself:
        i, j = i[i < j], j[i < j]
    test = _one_inserted if longer else _one_replaced
    step = max(1, LETTERS_AT_ONCE // max(1, b.shape[1]))
    found = [test(a[i[k : k + step]], b[j[k : k + step]]) for k in range(0, len(i), step)]
    kept = np.concatenate(found) if found else np.zeros(0, bool)
    return i[kept], j[kept]


def _best(own, other, counts):
    """Per word with near ones: its number, how many they are, and the commonest (ties: the first)."""
    order = np.lexsort((other, -counts[other], own))
    first = np.flatnonzero(np.append(True, own[order][1:] != own[order][:-1]))
    return own[order][first], np.diff(np.append(first, len(order))), other[order][first]


def _compared(batches):
    """Per word of a pair of blocks: how many words of the other are near it, and the commonest."""
    for batch in batches:
        found = []
        a, b, la, lb = (batch.column(c).to_numpy() for c in ("a", "b", "a_length", "b_length"))
        binary = [batch.column(c) for c in ("a_letters", "a_n", "b_letters", "b_n")]
        for row in range(batch.num_rows):
            left, left_n, right, right_n = (c[row].as_buffer() for c in binary)
            left_n, right_n = np.frombuffer(left_n, np.int64), np.frombuffer(right_n, np.int64)
            left = np.frombuffer(left, np.uint32).reshape(len(left_n), la[row])
            right = np.frombuffer(right, np.uint32).reshape(len(right_n), lb[row])
            i, j = near_pairs(left, right, itself=a[row] == b[row])
            if not len(i):
                continue
            sides = [(left, i, j, right, right_n), (right, j, i, left, left_n)]
            if a[row] == b[row]:
                sides = [(left, np.concatenate([i, j]), np.concatenate([j, i]), left, left_n)]
            for mine, own, other, names, counts in sides:
                who, near, best = _best(own, other, counts)
                found.append((_words(mine[who]), near, counts[best], _words(names[best])))
        if found:
            words, near, most, best = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(chain.from_iterable(words), pa.string()),
                    pa.array(np.concatenate(near)),
                    pa.array(np.concatenate(most)),
                    pa.array(chain.from_iterable(best), pa.string()),
                ],
                ["word", "n_near", "best_n", "best"],
            )


def _neighbours(blocks, groups):
    """Pairs of blocks that words one edit apart can be in, each pair once."""
    shares = SHARES[:groups]
    moved = [(0, y - x) for x, y in combinations(shares, 2)]
    steps = [(0, 0), *moved, *((1, s) for s in shares)]
    offers = F.explode(
        F.array(*[F.struct(F.lit(l).alias("l"), F.lit(k).cast("bigint").alias("k")) for l, k in steps])
    ).alias("step")
    left = blocks.select(F.col("block").alias("a"), "length", "key", offers).select(
        "a",
        (F.col("length") + F.col("step.l")).alias("length"),
        (F.col("key") + F.col("step.k")).alias("key"),
        ((F.col("step.l") == 0) & (F.col("step.k") == 0)).alias("alike"),
    )
    pairs = left.join(blocks.select(F.col("block").alias("b"), "length", "key"), ["length", "key"])
    # of blocks of one length and key each pair would come twice
    return pairs.where("NOT alike OR a <= b").select("a", "b")


def _near(blocks, groups):
    """Number of near words and the commonest near word of each word that has any."""
    pairs = _neighbours(blocks.select("block", "length", "key"), groups)

    def side(name):
        return blocks.select(
            F.col("block").alias(name),
            *(F.col(c).alias(f"{name}_{c}") for c in ("length", "letters", "n")),
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    found = map_arrow(both, _compared, NEAR)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best"),
    )


def _roots(forms):
    """Where the forms of ``(word, form)`` lead: each round follows twice as many."""
    ways = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = stored(
            ways.join(on, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")
            ),
            "roots",
        )
        if ways.where("went").isEmpty():
            return ways.select("word", "root")


def spelling_groups(words, factor=2, block_words=BLOCK_WORDS):
    """One row per word of ``(word, n)``: ``word, form, root, n, n_near, form_n``.

    Words are near if they differ by exactly one inserted, deleted or replaced code point. ``form``
    is the near word of largest ``n`` (ties: the first in code-point order) if that is at least
    ``factor`` times the word's own, else null; ``form_n`` is its count. ``root`` is where forms lead,
    the word itself without one; as counts grow along the way, it always ends. ``n_near`` counts near
    words.

    Repeated words are one, with the sum of their counts. Null words are left out, a null count is
    zero; the empty word is near the words of one letter. Words may be of any length and
    script. An empty table gives no rows; other columns are not read.

    Blocks hold at most ``block_words`` words, so however many words share a length and letters, a
    task compares two bounded blocks at a time, and pairs of blocks are dealt out evenly.
    """
    words = words.where(F.col("word").isNotNull()).groupBy("word")
    words = stored(words.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")), "words")
    groups = groups_for(words.count())
    keyed = map_arrow(words, partial(_keyed, groups=groups), "word string, n long, length int, key long")
    dealt = keyed.repartitionByRange("length", "key", "word").sortWithinPartitions("length", "key", "word")
    blocks = stored(map_arrow(dealt, partial(_cut, most=block_words), BLOCKS), "blocks")
    enough = F.col("best.n") * -1 >= factor * F.col("n")
    described = words.join(_near(blocks, groups), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"),
        F.when(enough, -F.col("best.n")).alias("form_n"),
    )
    described = stored(described, "forms")
    roots = _roots(described.where("form IS NOT NULL"))
    return described.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
