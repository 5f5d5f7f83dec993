"""Benchmark decontamination by spaced-seed hashing, in built-in functions only."""

from functools import reduce

from pyspark.sql import functions as F

from commwatch.functions.binding import bind
from commwatch.llm.storage import stored

WORD = r"[\p{L}\p{N}]+"
# Two texts share a passage where, in some window of these many aligned words, this share is equal.
LEAST_WORDS, MOST_WORDS = 13, 25
LEAST_MATCH = 0.7
# Masks over consecutive words: 1 is hashed, 0 is ignored. Chosen greedily until every pattern of
# equal and replaced words that the rule admits holds one of them; the tests enumerate all patterns.
MASKS = ("110111", "111101", "1010111", "11001011", "1101000011", "111000100001")
# Seeds in one broadcast table, three numbers each; a benchmark with more is searched in passes.
BLOCK_SEEDS = 2_000_000
# A seed speaks for all windows around its tile of the item: the tile and its surroundings are one
# word of 64 bits, so what is compared does not grow with the item.
TILE = 8
REACH = MOST_WORDS - 1
WIDTH = TILE + 2 * REACH
BITS = 64


def words_of(text):
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _hashed_words(text):
    return bind(words_of(text), lambda w: F.transform(w, lambda x: F.xxhash64(x)))


def _with_seeds(df, masks, fits=lambda mask: F.lit(True)):
    """``df`` with the columns ``place`` and ``seed``, a row per place of ``words`` and mask.

    ``words`` is an array of word hashes. Places and masks are exploded one after the other, so
    that each hash is a compiled expression and not a function called per array element.
    """
    shortest = min(map(len, masks))
    places = F.when(
        F.size("words") >= shortest, F.sequence(F.lit(0), F.size("words") - shortest)
    )
    placed = df.withColumn("place", F.explode(places))

    def seed(mask):
        chosen = [k for k, bit in enumerate(mask) if bit == "1"]
        words = (F.get("words", F.col("place") + k) for k in chosen)
        inside = F.col("place") + len(mask) <= F.size("words")
        return F.when(inside & fits(mask), F.xxhash64(F.lit(mask), *words))

    return placed.withColumn("seed", F.explode(F.array(*map(seed, masks)))).where(
        "seed IS NOT NULL"
    )


def _frame(words, begin):
    """The ``WIDTH`` words from a place on, which may lie before the first word."""
    low = F.greatest(begin, F.lit(0))
    return F.slice(words, low + 1, F.lit(WIDTH) - (low - begin))


def _bit(place):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _equal_bits(seen, text_begin, item, item_begin):
    """A bit per place of two frames whose words are equal; places outside either are unequal."""

    def word(frame, begin, k):
        return F.get(frame, k + F.least(begin, F.lit(0)))

    def step(bits, k):
        same = word(seen, text_begin, k) == word(item, item_begin, k)
        return bits + F.when(same, _bit(k)).otherwise(F.lit(0).cast("bigint"))

    zero = F.lit(0).cast("bigint")
    return F.aggregate(F.sequence(F.lit(0), F.lit(WIDTH - 1)), zero, step)


def _least_equal(n):
    """Equal words that a window of ``n`` words needs, in whole numbers."""
    return -(-round(100 * LEAST_MATCH) * n // 100)


def _in_windows(bits):
    """The bits that lie in a window of enough equal words."""
    zero = F.lit(0).cast("bigint")

    def from_place(k):
        windows = [
            F.when(
                F.bit_count(bits.bitwiseAND(window)) >= _least_equal(n), window
            ).otherwise(zero)
            for n in range(LEAST_WORDS, MOST_WORDS + 1)
            for window in [F.call_function("shiftleft", F.lit((1 << n) - 1).cast("bigint"), k)]
        ]
        return reduce(lambda a, b: a.bitwiseOR(b), windows)

    starts = F.sequence(F.lit(0), F.lit(WIDTH - LEAST_WORDS))
    union = F.aggregate(starts, zero, lambda found, k: found.bitwiseOR(from_place(k)))
    return bits.bitwiseAND(union)


def _matched_bits(equal):
    """The bits of ``equal`` in windows of enough equal words, or all of a short item; else none.

    An array of one number or none, to be exploded: a filter would compute the numbers twice.
    """
    short = F.col("item_words") < LEAST_WORDS
    least = F.when(short, F.col("item_words")).otherwise(_least_equal(LEAST_WORDS))
    enough = F.filter(F.array(equal), lambda bits: F.bit_count(bits) >= least)
    matched = F.transform(
        enough,
        lambda bits: F.when(short, bits).otherwise(_in_windows(bits)),
    )
    return F.filter(matched, lambda bits: bits != 0)


def _by_words(begin):
    """The matched bits of a frame as up to two whole words of bits, counted from the item's start."""
    first = F.floor(begin / BITS)
    offset = (begin - first * BITS).cast("int")
    low = F.call_function("shiftleft", F.col("matched"), offset)
    high = F.when(
        offset > 0, F.call_function("shiftrightunsigned", F.col("matched"), BITS - offset)
    ).otherwise(F.lit(0).cast("bigint"))
    both = F.array(
        F.struct(first.alias("number"), low.alias("bits")),
        F.struct((first + 1).alias("number"), high.alias("bits")),
    )
    return F.filter(both, lambda part: part["bits"] != 0)


def benchmark_hits(docs, benchmark, doc_id="doc_id", item_id="item_id", masks=MASKS,
                   block_seeds=BLOCK_SEEDS, carry=()):
    """One row per document, benchmark item and place where the item's words occur in the text.

    Columns: ``doc_id``, ``item_id``, ``shift`` (word of the text at which the item starts; may
    be negative), ``from_word`` and ``to_word`` (in the text, inclusive), ``matched`` (equal
    words), ``item_words``, and the columns named in ``carry``.

    The rule: with the item laid over the text at ``shift``, a window of 13 to 25 consecutive words
    of the item of which 70 % are equal is a hit, wherever the window lies; words beyond either end
    of the text count as replaced. ``matched`` counts the equal words in such windows, ``from_word``
    and ``to_word`` are the first and the last of them. An item of fewer than 13 words is a hit where
    it stands word for word, even one of a single word. Every such hit is found: the masks hold a
    seed for each pattern that the rule admits, and items too short for a mask are hashed whole.

    Null and empty texts and items have no words and no hits. Items with equal texts each count;
    repeated documents, and repeated rows of an item, are one unless ``carry`` or the item's id tells
    them apart. Texts and items may be of any length, other columns of any name. Empty inputs
    give no rows.

    The texts never move: each keeps its place in the scan, and its seed hashes meet the seeds of
    the benchmark in a broadcast table of fixed-size rows. A benchmark with more than
    ``block_seeds`` seeds is dealt by tiles of items into blocks of about that size, one pass each.
    The seeds of a tile of an item lead to one row with the text around it, of fixed width, so the
    work is linear in the length of an item and no seed in a third of all texts gathers a list.
    """
    items = benchmark.select(
        F.col(item_id).alias("item_id"), _hashed_words(F.col("text")).alias("words")
    )
    items = stored(
        items.distinct()
        .withColumn("item_words", F.size("words"))
        .where("item_words > 0")
        .withColumn("item_no", F.monotonically_increasing_id()),
        "items",
    )
    shortest = min(map(len, masks))
    lengths = items.where(F.col("item_words") < shortest).select("item_words").distinct()
    whole = {"1" * r.item_words for r in lengths.collect()}  # fewer than the shortest mask's places
    masks = (*masks, *sorted(whole))
    seeds = stored(
        _with_seeds(
            items, masks,
            lambda mask: (F.col("item_words") == len(mask)) if mask in whole else F.lit(True),
        ).select(
            "seed", "item_no", F.floor(F.col("place") / TILE).cast("int").alias("tile"),
            F.col("place").alias("item_place"),
        ),
        "seeds",
    )
    begin = F.col("tile") * TILE - REACH
    tiles = items.withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.floor((F.col("item_words") - 1) / TILE).cast("int")))
    ).select("item_no", "item_id", "item_words", "tile", _frame(F.col("words"), begin).alias("item"))
    blocks = max(1, -(-seeds.count() // block_seeds))
    texts = docs.select(
        F.col(doc_id).alias("doc_id"), _hashed_words(F.col("text")).alias("words"), *carry
    )
    places = _with_seeds(texts, masks)
    shift = F.col("place") - F.col("item_place")

    def dealt(df, block):
        return df.where(F.pmod(F.xxhash64("item_no", "tile"), F.lit(blocks)) == block)

    def search(block):
        found = places.join(F.broadcast(dealt(seeds, block)), "seed").select(
            "doc_id", *carry, "item_no", "tile", shift.alias("shift"),
            _frame(F.col("words"), begin + shift).alias("seen"),
        )
        # Stored before it is verified: interpreted expressions would be moved into the join, which
        # would then no longer be compiled together with the explosion of places.
        found = stored(found.distinct(), "hits")
        equal = _equal_bits(F.col("seen"), begin + F.col("shift"), F.col("item"), begin)
        verified = found.join(F.broadcast(dealt(tiles, block)), ["item_no", "tile"])
        return (
            verified.withColumn("matched", F.explode(_matched_bits(equal)))
            .withColumn("part", F.explode(_by_words(begin)))
            .select("doc_id", *carry, "item_no", "item_id", "item_words", "shift", "part.*")
        )

    hit = ["doc_id", *carry, "item_no", "item_id", "item_words", "shift"]
    parts = reduce(lambda a, b: a.unionByName(b), map(search, range(blocks)))
    parts = parts.groupBy(*hit, "number").agg(F.bit_or("bits").alias("bits"))
    at = F.col("shift") + F.col("number") * BITS
    lowest = F.instr(F.reverse(F.bin("bits")), "1") - 1
    highest = F.length(F.bin("bits")) - 1
    return (
        parts.groupBy(*hit)
        .agg(
            F.min(at + lowest).cast("bigint").alias("from_word"),
            F.max(at + highest).cast("bigint").alias("to_word"),
            F.sum(F.bit_count("bits")).alias("matched"),
        )
        .select(
            "doc_id", *carry, "item_id", F.col("shift").cast("bigint").alias("shift"),
            "from_word", "to_word", "matched", F.col("item_words").cast("bigint").alias("item_words"),
        )
        .distinct()
    )
