"""Documents to token ids in five stages, each of which works on what the one before has kept.

Every stage but the last returns the columns of ``documents``. Decisions: a document goes if its
language is not recognised, if a near duplicate with a smaller id stays, if nothing is left of it once
repeated passages are cut, or if it holds a passage of the benchmark. A decision holds for rows of the same id and text, so rows without an id are judged by
their text, and texts that share an id each for itself. Of rows with the same id and text one stays, also of those without an id; a row
without an id is not compared with rows that have one. The last stage gives each document's ids
and their round trip. Null ids and texts: see each operator.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from plantlake.llm import char_language, fold_bpe, lsh_forest, substring_levels, winnowing
from plantlake.llm.common import written
from plantlake.session import fresh_dir

#: A language counts as recognised from this share of the way between an even guess and certainty on: a
#: score of 0.265 among four languages. The least score of a document with letters was 0.312 over the
#: 0.1 GB table (51,282 of them); a share of 0.1 would have dropped two short clean ones.
ABOVE_CHANCE = 0.02
#: A missing ``lang`` is filled from a prediction of this calibrated score or more. Texts of languages that were not learned scored at most 0.65.
FILL_FROM = 0.9
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with letters and a score of ``ABOVE_CHANCE`` or more; all with letters if there
    was nothing to learn from. A null ``lang`` becomes the predicted one from a score of ``FILL_FROM`` on; others stay as given."""
    keep = tuple(c for c in COLUMNS if c != "doc_id")
    found = char_language.identified(docs, keep=keep, above_chance=ABOVE_CHANCE).where("recognised")
    return found.withColumn("lang", F.coalesce("lang", F.when(F.col("score") >= FILL_FROM, F.col("lang_pred")))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near duplicates (five-word shingles, similarity 0.8), and one row of those of one id and text:
    that with the smallest ``lang``, ``source`` and ``n_chars``, nulls first."""
    groups = lsh_forest.near_duplicates(docs.select("doc_id", "text"), size=5, percent=80, by_text=True)
    # Most documents are alone and need no mark.
    marks = groups.groupBy("doc_id", "text_hash").agg(F.bool_or(~F.col("kept")).alias("gone"), (F.count("*") > 1).alias("repeated"))
    marks = written(marks.where("gone or repeated").withColumnsRenamed({"doc_id": "i", "text_hash": "h"}), "pipeline-marks")
    same = docs["doc_id"].eqNullSafe(F.col("i")) & (lsh_forest.text_hash(docs) == F.col("h"))
    single = docs.join(marks, same, "left_anti")
    several = docs.join(marks.where("not gone"), same, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("x"))
    return single.unionByName(several.select("doc_id", "text", "x.lang", "x.source", "x.n_chars")).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words and more that a document with a smaller id also has."""
    out = substring_levels.deduplicated(docs, length=50, base=7, carry=tuple(c for c in COLUMNS if c not in ("text", "n_chars")))
    kept = out.where("n_removed = 0 or n_removed < n_words")
    return kept.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    found = winnowing.contamination(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keyed=True)
    return docs.withColumn("key", winnowing.row_key(docs)).join(found.where("contaminated").select("key").distinct(), "key", "left_anti").select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document as little-endian u32, their number, and digests of ids and decoded bytes."""
    out = fold_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language), ("near_duplicates", near_duplicates), ("substring_dedup", substrings),
    ("decontamination", decontaminated), ("encoding", encoded)]

#: Training a classifier, approximate candidate search and merging ranked byte pairs are not expressible in SQL; the
#: stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is stored and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_dir(spark, f"pipeline-{uuid.uuid4().hex[:8]}")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
