"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last
return the columns of documents. run() writes each stage's rows to the shared folder and reads them
back, so a lost executor costs at most one stage's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaloom.llm import jaccard, packing, quality, repeats, secrets
from taxaloom.llm.bpe import public_vocabulary
from taxaloom.llm.common import doc_key, documents, fresh, materialise, release, ship

#: No SQL: the first stage's model and the third's positions go beyond it. tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def _with_text(docs: DataFrame, text) -> DataFrame:
    """docs with another text and its number of characters."""
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns(columns)


def reject_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality.training_labels(spark, sf_dir))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates, the document with the smallest doc_id.

    A row is named by doc_id and text: documents without an id, or of one id, stay apart unless their
    texts are linked. Equal documents are one; of rows that differ in other columns alone, the first by
    those columns' hash stays.
    """
    ship(spark)
    found = jaccard.near_duplicates(docs.select("doc_id", "text"))
    key, digest, same, row, order = (fresh(docs, x) for x in ("kept_key", "kept_digest", "kept_same", "kept_row", "kept_order"))
    names = found.groupBy("component", doc_key(found).alias("key"), "text_hash").agg(F.count("*").alias("same"))
    kept = names.groupBy("component").agg(F.min(F.struct("key", "text_hash", "same")).alias("first")).select(F.col("first.key").alias(key), F.col("first.text_hash").alias(digest), F.col("first.same").alias(same))
    chosen = docs.withColumns({key: doc_key(docs), digest: F.xxhash64("text")}).join(kept, [key, digest])
    once = chosen.where(F.col(same) == 1).select(*docs.columns)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    hashed = chosen.where(F.col(same) > 1).withColumn(order, F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0))
    repeated = hashed.groupBy(key, digest).agg(F.min_by(F.struct(*docs.columns), order).alias(row))
    return once.unionByName(repeated.select(*(F.col(f"{row}.{c}").alias(c) for c in docs.columns)))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that a 100-byte string with an earlier start covers; a character cut in half becomes U+FFFD."""
    ship(spark)
    spans, kept = fresh(docs, "removed_spans"), fresh(docs, "kept")
    cut = repeats.remove_repeats(docs, spans=spans, kept=kept)
    text = F.when(F.col("text").isNotNull(), F.make_valid_utf8(F.col(kept).cast("string")))
    return _with_text(cut, text).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret masked."""
    base, entropy = fresh(docs, "base_spans"), fresh(docs, "entropy_spans")
    found = secrets.find_secrets(docs, base, entropy)
    return _with_text(found, secrets.mask(F.col("text"), F.concat(base, entropy))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 1024 tokens."""
    ship(spark)
    return packing.pack_documents(docs, public_vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", reject_bad),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", cut_repeats),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 == len(STAGES):
            return out
        out = materialise(out, f"stage{i}")
        release(docs)
        docs = out
    return docs
