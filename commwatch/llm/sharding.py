"""Shards by jump consistent hashing (Lamping and Veach, 2014), in built-in functions only."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from commwatch.functions.binding import bind
from commwatch.llm.storage import stored

# Fixed value: the multiplier of the generator in the published algorithm.
MULTIPLIER = 2862933555777941757
LAW = "key"
WIDE = "decimal(38,0)"


def _whole(number):
    return F.lit(str(number)).cast(WIDE)


def jump_hash(key, shards):
    """Shard of a whole-number key, 0 to ``shards`` - 1, as an int column.

    The published loop: a generator seeded by the key proposes ever larger shard numbers, and the
    last one below ``shards`` counts. Each round raises the number, so ``shards`` rounds suffice
    and rounds after the last jump change nothing. The state is a decimal: the generator works
    modulo 2^64, and the product of two such numbers fits 38 digits. A null key counts as 0.

    Going from n to n + 1 shards moves a key only if n is drawn, so only into the new shard.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    modulus, low = _whole(2**64), _whole(2**33)

    def step(state, _):
        drawn = F.pmod(state["k"] * _whole(MULTIPLIER) + _whole(1), modulus).cast(WIDE)

        def jump(k):
            high = ((k - F.pmod(k, low)) / low).cast("bigint")  # an exact division
            share = F.lit(float(2**31)) / (high + 1).cast("double")
            proposed = ((state["j"] + 1).cast("double") * share).cast("bigint")
            return F.struct(k.alias("k"), state["j"].alias("b"), proposed.alias("j"))

        return F.when(state["j"] >= shards, state).otherwise(bind(drawn, jump))

    seed = F.pmod(F.coalesce(key, F.lit(0)).cast(WIDE), modulus).cast(WIDE)
    start = F.struct(
        seed.alias("k"), F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j")
    )
    rounds = F.sequence(F.lit(1), F.lit(shards + 1))
    return F.aggregate(rounds, start, step, lambda state: state["b"].cast("int"))


def assign_shards(df, key="doc_id", shards=16, shard="shard"):
    """``df`` with its shard in a new column: narrow, so that a writer partitions by it directly."""
    return df.withColumn(shard, jump_hash(df[key], shards))


def shard_manifest(df, shards=16, key="doc_id", text="text"):
    """One row per document: shard, place in the shard and the shard after adding one more.

    Columns: the key, ``size`` (UTF-8 bytes and 1), ``text_crc32``, ``law``, ``shard``, ``slot``
    (0, 1, 2 ... in a shard, in the order of key, checksum and size, null keys first) and
    ``grown_shard``. Only the key decides, so equal texts under other keys may part.

    Null text has size 1 and the checksum of the empty text. Repeated rows each get a slot of their
    own. An empty input gives no rows. Other columns, whatever their names, are not read.

    Places come from two small shuffles of the manifest without the texts. Rows are dealt by range
    of (shard, key, ...) after equal ones were counted into one, so a key on a third of all rows is
    one row here. The dealing is stored, as its sampled bounds would differ when recomputed. Each
    range then numbers its own rows from the sum of the ranges before it; that sum covers a row
    per range and shard.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"),
        jump_hash(F.col(key), shards).alias("shard"),
        jump_hash(F.col(key), shards + 1).alias("grown_shard"),
    )
    order = ["doc_id", "text_crc32", "size"]
    dealt = (
        rows.groupBy("shard", *order, "grown_shard")
        .agg(F.count("*").alias("copies"))
        .repartitionByRange("shard", *order)
        .withColumn("part", F.spark_partition_id())
    )
    dealt = stored(dealt, "shards")
    parts = dealt.groupBy("shard", "part").agg(F.sum("copies").alias("rows"))
    before = parts.select(
        "shard",
        "part",
        (F.sum("rows").over(Window.partitionBy("shard").orderBy("part")) - F.col("rows")).alias(
            "before"
        ),
    )
    inside = Window.partitionBy("shard", "part").orderBy(*order)
    placed = dealt.withColumn("upto", F.sum("copies").over(inside)).join(before, ["shard", "part"])
    first = F.col("before") + F.col("upto") - F.col("copies")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        F.explode(F.sequence(first, first + F.col("copies") - 1)).alias("slot"),
        "grown_shard",
    )
