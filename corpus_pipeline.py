"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last
return the columns of their input.
"""

from pyspark.sql import functions as F

from commwatch.llm.decontamination import benchmark_hits
from commwatch.llm.ngram_jaccard import similar_components
from commwatch.llm.packing import pack_documents
from commwatch.llm.quality_rules import judge_quality
from commwatch.llm.queries import byte_vocabulary
from commwatch.llm.secrets import scan_secrets, train
from commwatch.llm.storage import stored

# SQL has no tokenizer and trains no network; tests/llm compares the stages with plain versions.
ORACLE_SQL = None
LOWEST = -(2**63)


def _known(docs):
    """Whole rows, with a number for their key and their text, which tell rows of a key apart."""
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST)).alias("key"),
        F.xxhash64("text").alias("hash"),
        "text",
    )


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    judged = judge_quality(docs.select(F.struct("*").alias("row"), F.col("text")))
    return judged.where("quality.kept").select("row.*")


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of similar ones: that with the smallest key.

    Documents without words are similar to none and stay.
    """
    found = similar_components(docs.select("doc_id", "text"), with_text_hash=True).select(
        F.coalesce("doc_id", F.lit(LOWEST)).alias("key"),
        F.col("text_hash").alias("hash"),
        (F.col("n_shingles") == 0).alias("alone"),
        "group",
    )
    group = F.when(F.col("alone"), F.xxhash64("key", "hash")).otherwise(F.col("group"))
    kept = found.groupBy(group.alias("group"), "alone").agg(
        F.min(F.struct("key", "hash")).alias("first")
    )
    kept = kept.select("first.*", "alone").distinct()
    joined = _known(docs).drop("text").join(kept, ["key", "hash"])
    # repeated rows are one group, unless they have no words
    number = F.when(F.col("alone"), F.monotonically_increasing_id()).otherwise(F.lit(0))
    once = joined.withColumn("number", number).dropDuplicates(["key", "hash", "number"])
    return once.select("row.*")


def decontamination(spark, docs, sf_dir):
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    known = _known(docs)
    hits = benchmark_hits(known.drop("row"), benchmark, doc_id="key", carry=("hash",))
    hits = hits.select(F.col("doc_id").alias("key"), "hash").distinct()
    return known.drop("text").join(hits, ["key", "hash"], "left_anti").select("row.*")


def secret_scan(spark, docs, sf_dir):
    """Documents with each secret replaced by its kind, and their new length."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    clean = scan_secrets(rows, train(docs.select("text")), columns=("row",), redact=True)
    found = F.col("spans") != ""
    new = {"text": F.col("clean_text"), "n_chars": F.char_length("clean_text")}

    def column(c):
        old = F.col("row").getField(c)
        if c not in new:
            return old.alias(c)
        return F.when(found, new[c].cast(docs.schema[c].dataType)).otherwise(old).alias(c)

    return clean.select(*map(column, docs.columns))


def packing(spark, docs, sf_dir):
    """Pieces of all documents in sequences of 256 to 2048 tokens."""
    return pack_documents(docs, byte_vocabulary(), end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scan", secret_scan),
    ("packing", packing),
]


def run(spark, sf_dir):
    """All stages on the documents of a folder, each stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
