"""The operators of this subpackage on the benchmark tables, with SQL where it can say the same."""

from pyspark.sql import functions as F

from commwatch.llm.cotraining import quality_scores
from commwatch.llm.decontamination import benchmark_hits
from commwatch.llm.hard_negatives import mine_hard_negatives
from commwatch.llm.ngram_jaccard import similar_components
from commwatch.llm.packing import pack_documents
from commwatch.llm.quality_rules import SQL as QUALITY_SQL
from commwatch.llm.quality_rules import quality_report
from commwatch.llm.records import token_records
from commwatch.llm.secrets import secret_report
from commwatch.llm.sharding import shard_manifest
from commwatch.llm.spelling import document_words, spelling_groups
from commwatch.llm.substring_dedup import remove_repeats
from commwatch.llm.token_counts import count_tokens
from commwatch.llm.toxicity import toxicity_report


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_vocabulary():
    """Path of the byte-level vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark, sf_dir):
    return toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_sharding(spark, sf_dir):
    return shard_manifest(_table(spark, sf_dir, "documents"), shards=16)


def op3_quality_classifier(spark, sf_dir):
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_packing(spark, sf_dir):
    return pack_documents(_table(spark, sf_dir, "documents"), byte_vocabulary(), end_id=1)


def op5_decontamination(spark, sf_dir):
    return benchmark_hits(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op6_secrets(spark, sf_dir):
    return secret_report(_table(spark, sf_dir, "documents"))


def op7_records(spark, sf_dir):
    return token_records(_table(spark, sf_dir, "documents"), byte_vocabulary(), end_id=0)


def op8_quality_rules(spark, sf_dir):
    return quality_report(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark, sf_dir):
    return remove_repeats(_table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark, sf_dir):
    return similar_components(_table(spark, sf_dir, "documents"))


def op11_token_counts(spark, sf_dir):
    return count_tokens(_table(spark, sf_dir, "documents"), byte_vocabulary())


def op12_spelling_variants(spark, sf_dir):
    """Words of all documents, one of 97 of a document's words with a letter missing."""
    return spelling_groups(document_words(_table(spark, sf_dir, "documents"), damage=97))


def op13_hard_negatives(spark, sf_dir):
    """Every hundredth vector as an anchor, one label of seven moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    return mine_hard_negatives(
        _table(spark, sf_dir, "embeddings").withColumns(
            {"label": F.coalesce(moved, "label"), "anchor": F.col("vec_id") % 100 == 0}
        )
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_secrets": op6_secrets,
    "op7_records": op7_records,
    "op8_quality_rules": op8_quality_rules,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL = {"op8_quality_rules": QUALITY_SQL}
