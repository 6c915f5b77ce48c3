"""Mixing sources to target weights by entropy balancing.

Among all rates ``r`` of documents that give every source its target in tokens,
the ones nearest to "each document once" are wanted. The distance is the
relative entropy, a document counting ``size / z`` with
``z = (size / mean) ** tilt``: with tilt 1 each document counts alike, with tilt 0
each token does. The solution is ``r = min(cap, exp(lambda * z))`` with one
multiplier per source, the root of a convex dual's gradient, found by Newton
steps: each step is one aggregation over all sources at once. Documents of a
source with equal size have equal rates, so the steps run over (source, size)
cells. Rates are then rounded into copies, the error of each cell being passed on
to the next smaller size.

All sums are exact decimals, so reruns agree. Source totals, cells and multipliers
stay in tables; the driver sees single sums only.

Defined cases: a null or empty text has size 0 and is never taken; a null source is
a source of its own, after all others; repeated rows are documents of their own;
an empty table gives an empty one; other columns are carried along unseen.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docwatch.llm.common import place_in_group, text_of, words
from docwatch.session import materialize

CAP = 3
WEIGHTS = (5, 2, 1)
TILT = 0.5
MAX_STEPS = 60
EXACT = "decimal(38,6)"


def ranked(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """Adds the row's place in the order of ``key`` over all rows, without one task sorting all."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = materialize(rows.repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = {r._part: r.n for r in cut.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    start, starts = 0, []
    for part in sorted(sizes):
        starts.append((part, start))
        start += sizes[part]
    first = rows.sparkSession.createDataFrame(starts, "_part int, _start long")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return cut.join(first, "_part").withColumn(name, F.col("_start") + inside).drop("_part", "_start")


def sized_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, mark``: words of the text, and a hash of row and text; written."""
    text = text_of("text")
    return materialize(
        docs.select("doc_id", "source", F.size(words(text)).cast("long").alias("size"), row_mark().alias("mark")),
        "sized",
    )


def row_mark() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Adds ``sid`` and ``target`` to ``source, source_size, ...``.

    Weights repeat over the sources in code point order. ``level`` is the tokens a
    unit of weight gets; it rises each time a source reaches its limit, until none
    is above.
    """
    by = F.col("source").asc_nulls_last()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    table = materialize(ranked(sources, by, "sid").withColumn("weight", weight), "sources")
    limit, level = cap * F.col("source_size"), 0.0
    while True:
        held = F.col("weight") * level > limit
        free = table.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(held, limit)).alias("full"),
            F.sum(F.when(~held, F.col("weight"))).alias("weight"),
        ).first()
        rest = float((free["all"] or 0) - (free["full"] or 0))
        higher = rest / free["weight"] if free["weight"] else level
        if higher <= level:
            break
        level = higher
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(level))
    return table.withColumn("target", target)


def _rate(cap: float) -> Column:
    free = F.exp(F.least(F.col("lam") * F.col("z"), F.lit(50.0)))
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), free))


def solve_dual(
    cells: DataFrame, sources: DataFrame, cap: float = CAP, tilt: float = TILT, steps: int = MAX_STEPS
) -> DataFrame:
    """``cells`` with ``rate``: Newton steps on all sources' multipliers, one aggregation each.

    A step outside the bracket known so far is replaced by its middle, so every
    source converges; steps end when each is within half a token of its target. Where one still
    isn't after ``steps`` of them, it raises.
    """
    z = F.pow(F.col("size") / F.col("mean"), F.lit(tilt))
    keep = cells.filter("size > 0").join(
        sources.select("sid", "mean", "target", (F.col("target") >= cap * F.col("source_size")).alias("full")), "sid"
    )
    keep = materialize(keep.withColumn("z", z), "cells")
    lam = F.log(F.greatest(F.col("target"), F.lit(1e-9)) / F.col("source_size"))
    state = sources.filter("source_size > 0").select(
        "sid", lam.alias("lam"), F.lit(-400.0).alias("low"), F.lit(400.0).alias("high")
    )
    state = materialize(state, "multipliers")
    for _ in range(steps):
        rate, tokens = _rate(cap), F.col("n") * F.col("size")
        slope = F.when(F.exp(F.least(F.col("lam") * F.col("z"), F.lit(50.0))) < cap, tokens * F.col("z") * rate)
        step = keep.filter("not full").join(state, "sid").groupBy("sid", "lam", "low", "high", "target").agg(
            F.sum((tokens * rate).cast(EXACT)).cast("double").alias("got"),
            F.sum(slope.cast(EXACT)).cast("double").alias("slope"),
        )
        off = F.col("got") - F.col("target")
        low = F.when(off < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - off / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (newton > F.col("new_low")) & (newton < F.col("new_high"))
        moved = step.withColumns({"new_low": low, "new_high": high}).select(
            "sid",
            F.when(F.abs(off) <= 0.5, F.col("lam"))
            .when(inside, newton)
            .otherwise((F.col("new_low") + F.col("new_high")) / 2)
            .alias("lam"),
            F.col("new_low").alias("low"),
            F.col("new_high").alias("high"),
            (F.abs(off) > 0.5).alias("open"),
        )
        moved = materialize(moved, "multipliers")
        state = moved.drop("open")
        if not moved.filter("open").limit(1).collect():
            break
    else:
        raise RuntimeError(f"mix: a source still misses its target after {steps} steps")
    solved = keep.join(state, "sid", "left").withColumn("rate", _rate(cap))
    return solved.select("sid", "size", "n", "target", "rate")


def round_cells(solved: DataFrame, cap: int = CAP) -> DataFrame:
    """``sid, size, n, rate, copies``: whole copies per cell, near the target of each source.

    A group holds the distinct sizes of a source, never its documents.
    """

    def per_source(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values("size", ascending=False)
        carry, copies = 0.0, np.zeros(len(cells), dtype=np.int64)
        for i, (size, n, rate) in enumerate(zip(cells["size"], cells["n"], cells["rate"])):
            wanted = n * rate + carry / size
            copies[i] = min(max(round(wanted), 0), cap * n)
            carry = (wanted - copies[i]) * size
        return cells.assign(copies=copies)[["sid", "size", "n", "rate", "copies"]]

    return solved.groupBy("sid").applyInPandas(per_source, "sid long, size long, n long, rate double, copies long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, tilt: float = TILT,
        bucket_rows: int = 1 << 20) -> DataFrame:
    """``doc_id, mark, source, size, source_size, target, rate, copies, taken``: one row per row of ``docs``."""
    sized = sized_documents(docs)
    cells = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "counts")
    tokens = F.col("n") * F.col("size")
    sums = cells.groupBy("source").agg(
        F.sum(tokens).alias("source_size"),
        (F.sum((tokens * F.col("size")).cast("decimal(38,0)")) / F.sum(tokens)).cast("double").alias("mean"),
    )
    sources = materialize(source_targets(sums, weights, cap), "targets")
    same = cells["source"].eqNullSafe(sources["source"])
    numbered = cells.join(sources, same).select("sid", "size", "n")
    rounded = materialize(round_cells(solve_dual(numbered, sources, cap, tilt), cap), "copies")
    rows = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "doc_id", "mark", sized["source"], "size", "source_size", "target", "sid"
    )
    placed = place_in_group(rows.filter("size > 0"), ["sid", "size"], ["mark", "doc_id"], rounded, bucket_rows)
    given = placed.join(rounded.withColumnRenamed("copies", "total"), ["sid", "size"])
    extra = F.when(F.col("place") < F.col("total") % F.col("n"), 1).otherwise(0)
    copies = (F.floor(F.col("total") / F.col("n")) + extra).cast("long")
    columns = ["doc_id", "mark", "source", "size", "source_size", "target"]
    taken = given.select(*columns, "rate", copies.alias("copies"))
    none = rows.filter("size = 0").select(*columns, F.lit(0.0).alias("rate"), F.lit(0).cast("long").alias("copies"))
    return taken.union(none).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows alike in id and text share their copies evenly; what is left over goes to
    one of them.
    """
    counts = mix(docs, weights, cap).groupBy("doc_id", "mark").agg(F.sum("copies").alias("c"), F.count("*").alias("m"))
    each, over = F.floor(F.col("c") / F.col("m")), F.col("c") % F.col("m")
    counts = counts.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), each.alias("each"), over.alias("over"))
    counts = materialize(counts.filter("each > 0 or over > 0"), "mix")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_doc"), row_mark().alias("_row_mark"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_row_mark") == F.col("_mark"))

    def repeated(found: DataFrame, times: str) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))
        return found.filter(F.col(times) > 0).select("row", copies.alias("copy")).select("row.*")

    taken = repeated(rows.join(counts.filter("each > 0"), same), "each")
    if counts.filter("over > 0").isEmpty():  # the usual case: no row is repeated
        return taken
    left = rows.join(counts.filter("over > 0"), same).groupBy("_id", "_mark").agg(
        F.min("row").alias("row"), F.first("over").alias("over")
    )
    return taken.union(repeated(left, "over"))
