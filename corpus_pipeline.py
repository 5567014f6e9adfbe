"""From raw documents to packed training sequences: five stages over the whole table.

Each stage works on what the one before kept, and its decisions take effect. All but the last return
the columns of documents; the last returns one row per packed piece of a document. Between two stages
the rows lie in the shared folder, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import decontamination, language, near_dedup, packing, pii
from wattline.llm.tables import held_out, load, quoted, stored
from wattline.session import fresh_dir, remove_dir

# A text is rejected if no language has more than this probability; far below what clean texts get. Junk
# with letters is not told by it but by the machines of ``language.fit_genuine``.
LEAST_LANGUAGE_SCORE = 0.3
NEAR = near_dedup.Setting(words=5, percent=80)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without letters, junk and texts of no recognisable language."""
    model = language.train(docs.where(~held_out(F.col("doc_id"))), genuine=True)
    found = language.identify(docs, model, lang="__wl_lang", score="__wl_score")
    if model is None:  # nothing to learn from, so nothing to judge by
        return docs
    known = (F.col("__wl_lang") != language.UNKNOWN) & (F.col("__wl_score") > LEAST_LANGUAGE_SCORE)
    return found.where(known).select(*map(quoted, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return near_dedup.keep_one(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    keyed = docs.withColumn("__wl_hash", F.xxhash64("text"))
    found = decontamination.contaminated(keyed, load(spark, sf_dir, "benchmark"), key="__wl_hash")
    leaks = stored(found.select(F.col("key").alias("__wl_hash")).distinct(), "leaks")
    return keyed.join(leaks, "__wl_hash", "left_anti").select(*map(quoted, docs.columns))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in place of every span of personal data."""
    return pii.redact(docs, pii.train(docs))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in the packed sequences."""
    packed = packing.pack(packing.pieces(docs))
    return packed.drop("ids").withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", redact_pii),
    ("packing", pack_tokens),
]

# The models of two stages are trained, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. A stage's copy of them goes once the next stage is written."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_dir(spark, f"stage-{name}")
        done = stage(spark, docs, sf_dir)
        done.write.parquet(path)
        docs = spark.read.schema(done.schema).parquet(path)
        if before is not None:
            remove_dir(spark, before)
        before = path
    return docs
