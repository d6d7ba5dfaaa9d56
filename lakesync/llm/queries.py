"""The registered queries of this subpackage, one per operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (chat, decontaminate, fingerprints, language_id, lexical, licenses, near_dedup, packing, pii, quality,
               secrets_scan, sharding, spelling)
from .common import table

TOKENIZER_FILE = "word_bpe_49k.json"
OWN_CONVERSATION, OWN_TEXT = -7, "</s>[INST] ok [/INST]"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER_FILE)


def op1_language_id(spark, sf_dir):
    return language_id.predict_documents(table(spark, sf_dir, "documents"))


def op2_license_scan(spark, sf_dir):
    """A document's path: its source and language as directories, its id as the file."""
    docs = table(spark, sf_dir, "documents").withColumn("path", F.concat_ws(
        "/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string")))
    found = licenses.scan(docs.select("path", "text"))
    return found.withColumn("doc_id", F.substring_index("path", "/", -1).cast("long"))


def op3_secret_scan(spark, sf_dir):
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


def op4_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(OWN_CONVERSATION, i, role, OWN_TEXT) for i, role in enumerate(("user", "assistant"))], turns.schema)
    return chat.read_back(chat.format_conversations(turns.unionByName(own)))


def op5_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op6_pii_surrogates(spark, sf_dir):
    return pii.replace_pii(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_decontamination(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_minhash_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op10_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark, sf_dir):
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_quality_classifier(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_license_scan, op3_secret_scan, op4_chat_format, op5_sharding, op6_pii_surrogates,
    op7_best_fit_packing, op8_decontamination, op9_minhash_dedup, op10_fingerprints, op11_lexical_search,
    op12_quality_classifier, op13_spelling_variants)}

ORACLE_SQL = {"op5_sharding": sharding.ORACLE_SQL, "op11_lexical_search": lexical.ORACLE_SQL}
