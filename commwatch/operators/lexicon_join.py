"""Scoring against a lexicon too large to write into the plan."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from commwatch.functions.binding import text_list

BROADCAST_WORDS = 200_000
SAMPLE_ROWS = 1000  # and as many more as there may be heavy words
HEAVY_PER_TASK = 4


def is_small(lexicon, max_words=BROADCAST_WORDS):
    """Whether a lexicon table has at most ``max_words`` rows; reads no more than that plus one.

    The table is evaluated here and again where it is joined: store one that is costly to derive.
    """
    return lexicon.limit(max_words + 1).count() <= max_words


def class_sets(lexicon):
    """One row per word of a table ``(class_id, word)``: the word as ``token`` and its ``classes``.

    A join with it cannot multiply tokens. The sets are bounded by the number of classes. No word is
    too long: a token may grow when it is lower-cased.
    """
    return (
        lexicon.where(F.col("word").isNotNull())
        .groupBy(F.col("word").alias("token"))
        .agg(F.collect_set("class_id").alias("classes"))
    )


def heavy_words(df, key, counts="counts", tasks=None, sample_rows=None):
    """Tokens so common that a task of a join would be dealt too many rows of one of them.

    A token is heavy if it makes up ``1 / (HEAVY_PER_TASK * tasks)`` of the rows of the join or more,
    so there are at most ``HEAVY_PER_TASK * tasks`` of them; ``tasks`` is the number of shuffle
    partitions by default. They are counted on about ``sample_rows`` rows, chosen by the hash of
    ``key`` before the texts of the others are looked at: which words are heavy decides how rows are
    dealt out and never what a row scores.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample_rows = sample_rows or SAMPLE_ROWS + HEAVY_PER_TASK * tasks
    share = min(1.0, sample_rows / max(df.select(key).count(), 1))
    drawn = F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    # the outer form keeps Catalyst from inferring a filter that would count the tokens twice
    tokens = df.where(drawn).select(F.explode_outer(counts).alias("c")).select("c.token")
    found = tokens.groupBy("token").agg(F.count("token").alias("n"))
    seen = Observation()
    found = found.observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    most = found.orderBy(F.desc("n"), "token").limit(HEAVY_PER_TASK * tasks).collect()
    least = max(2, seen.get["total"] / (HEAVY_PER_TASK * tasks))
    return sorted(r.token for r in most if r.n >= least)


def kept_words(words):
    """Words of ``class_sets`` cached as ``with_classes`` joins them, for many joins with small inputs.

    The cached side is dealt out once; only the other one is shuffled then.
    """
    return words.withColumn("spread", F.xxhash64("token")).repartition("token", "spread").persist()


def with_classes(rows, key, words, heavy=()):
    """``rows`` with the ``classes`` of each ``token``, null for one that is no word.

    Heavy words are looked up in their few broadcast entries, and their rows go to any task by
    ``key``, as rows without a token do. All other words meet ``words`` in one join on the token, so
    no copy is made of any entry.
    """
    if "spread" not in words.columns:
        words = words.withColumn("spread", F.xxhash64("token"))
    is_heavy = F.expr(f"token IN ({text_list(sorted(set(heavy)))})") if heavy else F.lit(False)
    light = F.when(~is_heavy, F.col("token"))
    # a second key, as nulls alone would all go to one task
    own = F.when(F.col("light").isNull(), F.xxhash64(*key)).otherwise(F.xxhash64("light"))
    spread = rows.withColumn("light", light).withColumn("spread", own)
    joined = spread.join(words.withColumnRenamed("token", "light"), ["light", "spread"], "left")
    if heavy:
        few = words.where(is_heavy).select("token", F.col("classes").alias("heavy_classes"))
        joined = joined.join(F.broadcast(few), "token", "left").withColumn(
            "classes", F.coalesce("heavy_classes", "classes")
        )
    return joined.drop("light", "spread", "heavy_classes")


def class_sums(class_ids, n="n", classes="classes"):
    """Hits per class, in the order of ``class_ids``, as an array to aggregate rows by."""
    def hits(class_id):
        member = F.coalesce(F.array_contains(classes, F.lit(class_id)), F.lit(False))
        return F.sum(F.when(member, F.col(n)).otherwise(F.lit(0).cast("bigint")))

    return F.array(*[hits(c) for c in class_ids])


def hits_by_join(df, key, lexicon, class_ids, counts="counts", broadcast=None, heavy=None):
    """Token total and hits per class of each row, by a join with a table ``(class_id, word)``.

    ``key`` must identify a row of ``df``. The lexicon is broadcast when its checked size allows.
    Otherwise both sides are shuffled on the word, but for ``heavy`` words (``heavy_words`` where
    none are given): a word that is in every text leaves no task with more rows than others, and the
    lexicon is shuffled once.

    Returns ``key, total, hits`` with the hits in the order of ``class_ids``.
    """
    if broadcast is not False:
        small = is_small(lexicon)
        if broadcast and not small:
            raise ValueError(f"a lexicon of more than {BROADCAST_WORDS} words is not broadcast")
        broadcast = small
    words = class_sets(lexicon)
    rows = df.select(key, F.explode_outer(counts).alias("c")).select(key, "c.token", "c.n")
    if broadcast:
        joined = rows.join(F.broadcast(words), "token", "left")
    else:
        if heavy is None:
            heavy = heavy_words(df, key, counts)
        joined = with_classes(rows, (key,), words, heavy)
    return joined.groupBy(key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), class_sums(class_ids).alias("hits")
    )
