"""Token totals kept up by signed deltas.

A batch of changes (insert, delete, revise) becomes signed sums per source,
language and tokenizer version. Every attempt to commit a batch writes a folder of
its own, and a marker written last names the attempt that counts. A batch with a
marker is never written again: one that is sent twice counts once, and a second
commit that breaks off, wherever it does, leaves the first as it is. Totals are the
sum of the marked attempts; :func:`compact` folds old batches into one.

Defined cases: a null source or language is a group of its own; a null text counts
no tokens but one document; a null count is 0; repeated change rows each count;
an empty batch commits nothing but its id; other columns aren't read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docwatch.llm.common import text_of, words

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def inserts(docs: DataFrame, tokenizer: str, count: Column | None = None) -> DataFrame:
    """A change row per document; ``count`` is its tokens, words if not given."""
    tokens = count if count is not None else word_count(text_of("text"))
    return docs.select(
        F.lit("insert").alias("change"),
        "source",
        "lang",
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(None).cast("long").alias("old_tokens"),
        F.coalesce(tokens, F.lit(0)).cast("long").alias("new_tokens"),
    )


def signed(changes: DataFrame) -> DataFrame:
    """``source, lang, tokenizer, docs, tokens`` summed over a batch.

    ``changes`` has ``change`` (insert, delete or revise), the keys, ``old_tokens``
    (what a delete or a revision takes back) and ``new_tokens``. Rows combine before
    the shuffle, so a hot source costs a row per task.
    """
    old, new = F.coalesce("old_tokens", F.lit(0)), F.coalesce("new_tokens", F.lit(0))
    docs = F.expr("CASE change WHEN 'insert' THEN 1 WHEN 'delete' THEN -1 WHEN 'revise' THEN 0 END")
    tokens = (
        F.when(F.col("change") == "insert", new)
        .when(F.col("change") == "delete", -old)
        .when(F.col("change") == "revise", new - old)
    )
    sums = changes.groupBy(*KEYS).agg(F.sum(docs).alias("docs"), F.sum(tokens).alias("tokens"))
    return sums.filter((F.col("docs") != 0) | (F.col("tokens") != 0))


def commit(changes: DataFrame, path: str, batch_id: str) -> bool:
    """Write a batch under its id, unless it is committed already; says whether it was written.

    Should two commits of one id run at the same time, both may leave a marker; the
    attempt of the lowest name counts, for every reader.
    """
    if _is_committed(changes.sparkSession, path, batch_id):
        return False
    _write(signed(changes), path, batch_id)
    return True


def _write(sums: DataFrame, path: str, batch_id: str) -> None:
    attempt = f"{batch_id}.{uuid.uuid4().hex}"
    sums.coalesce(1).write.parquet(f"{path}/deltas/batch={attempt}")
    mark = sums.sparkSession.createDataFrame([(attempt,)], "done string")
    mark.coalesce(1).write.mode("append").parquet(f"{path}/commits/batch={batch_id}")


def _is_committed(spark: SparkSession, path: str, batch_id: str) -> bool:
    """Whether a marker is there; a folder in which writing one broke off has none."""
    folder = f"{path}/commits/batch={batch_id}"
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    if not place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place):
        return False
    return not spark.read.schema("done string").parquet(folder).isEmpty()


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``batch`` and its deltas, of finished batches."""
    marks = spark.read.option("basePath", f"{path}/commits").schema("done string, batch string").parquet(f"{path}/commits")
    named = marks.groupBy("batch").agg(F.min("done").alias("done"))
    deltas = spark.read.option("basePath", f"{path}/deltas").schema(f"{DELTA}, batch string").parquet(f"{path}/deltas")
    return deltas.withColumnRenamed("batch", "done").join(named, "done").drop("done")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """``source, lang, tokenizer, docs, tokens`` over all committed batches."""
    sums = committed(spark, path).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return sums.filter((F.col("docs") != 0) | (F.col("tokens") != 0))


def compact(spark: SparkSession, path: str, into: str) -> None:
    """The totals as one first batch of a new store; the old store stays as it is."""
    _write(totals(spark, path), into, "base")
