"""URL filter: host and path rules first, then boosted trees on lexical features.

Only DataFrame functions and Spark's own tree learner are used; no URL leaves the
JVM. The learner is fitted on labelled URLs only, at most ``max_labelled`` of them
(chosen by hash); the statistics of suffixes are counted over all labelled URLs, and
a URL that is learned from has them without its own fold of the labels.

Defined cases: a null URL, or one without ``://``, has an empty host and path and is
judged like any other; without labels, or with labels of one kind only, the
learner's verdict is that kind (allow if there are none); repeated rows are judged
alike; an empty table gives an empty one; other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwatch.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


@dataclass(frozen=True)
class Training:
    """``smoothing`` is how many URLs of the mean rate a suffix's count is mixed with."""

    max_labelled: int = 200_000
    trees: int = 20
    depth: int = 3
    step: float = 0.1
    least_node: int = 20
    smoothing: float = 20.0
    threshold: float = 0.5
    seed: int = 7


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct ``text, verdict``; null if none does.

    Rules are configuration and become one CASE expression.
    """
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, characters, ""))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for the empty text."""
    n = F.length(text)
    share = lambda c: F.length(F.replace(text, c, F.lit("")))  # noqa: E731  what is left without c
    parts = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - share(c)) / n)
    bits = F.aggregate(parts, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(n > 0, bits).otherwise(0.0)


LEXICAL = {
    "url_length": lambda: F.length("url_text"),
    "host_length": lambda: F.length("host"),
    "host_depth": lambda: F.size(F.split("host", r"\.")),
    "path_depth": lambda: F.size(F.filter(F.split("path", "/"), lambda x: x != "")),
    "digit_ratio": lambda: _count(F.col("url_text"), "[0-9]") / F.greatest(F.length("url_text"), F.lit(1)),
    "host_digits": lambda: _count(F.col("host"), "[0-9]"),
    "hyphens": lambda: _count(F.col("url_text"), "-"),
    "entropy": lambda: entropy(F.col("url_text")),
    "host_entropy": lambda: entropy(F.col("host")),
    "parameters": lambda: F.when(F.col("query") == "", 0).otherwise(F.size(F.split("query", "&"))),
    "query_length": lambda: F.length("query"),
    "secure": lambda: F.col("url_text").startswith("https:").cast("int"),
}
SUFFIXES = {
    "top_suffix": lambda: F.element_at(F.split("host", r"\."), -1),
    "site_suffix": lambda: F.array_join(F.slice(F.reverse(F.split("host", r"\.")), 1, 2), "."),
    "file_suffix": lambda: F.regexp_extract("path", r"\.([A-Za-z0-9]{1,8})$", 1),
}
FEATURES = [*LEXICAL, *(f"{s}_rate" for s in SUFFIXES), *(f"{s}_count" for s in SUFFIXES)]


def with_features(urls: DataFrame) -> DataFrame:
    """``url`` and everything lexical about it; one row per row."""
    url = F.col("url")
    rows = urls.withColumns(
        {
            "url_text": F.coalesce(url, F.lit("")),
            "host": url_host(url),
            "path": url_path(url),
            "query": F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit("")),
        }
    )
    rows = rows.withColumns({k: f().cast("double") for k, f in LEXICAL.items()})
    return rows.withColumns({k: F.coalesce(f(), F.lit("")) for k, f in SUFFIXES.items()})


FOLDS = 5


def suffix_rates(labelled: DataFrame) -> tuple[dict[str, DataFrame], float]:
    """For each kind of suffix a table ``suffix, fold, bad, n`` of sums, and the mean rate.

    A null ``fold`` stands for all of them.
    """
    mean = labelled.agg(F.avg("bad")).first()[0] or 0.0
    tables = {}
    for kind in SUFFIXES:
        sums = labelled.groupBy(kind, "fold").agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
        tables[kind] = materialize(sums, kind)
    return tables, mean


def _with_rates(rows: DataFrame, tables: dict[str, DataFrame], mean: float, smoothing: float) -> DataFrame:
    """Adds rate and count of each suffix, and the assembled features.

    ``rows.fold`` is null for a row that is judged; a row that is learned from has its
    own fold, whose labels are left out of its rates.
    """
    for kind, table in tables.items():
        whole = table.groupBy(kind).agg(F.sum("bad").alias("_bad"), F.sum("n").alias("_n"))
        own = table.select(kind, "fold", F.col("bad").alias("_own_bad"), F.col("n").alias("_own_n"))
        rows = rows.join(whole, kind, "left").join(own, [kind, "fold"], "left")
        zero = F.lit(0)
        bad = F.coalesce("_bad", zero) - F.coalesce("_own_bad", zero)
        n = F.coalesce("_n", zero) - F.coalesce("_own_n", zero)
        rows = rows.withColumns({f"{kind}_rate": (bad + smoothing * mean) / (n + smoothing), f"{kind}_count": F.log1p(n)})
        rows = rows.drop("_bad", "_n", "_own_bad", "_own_n")
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(rows)


def score_urls(urls: DataFrame, labelled: DataFrame, training: Training = Training()) -> DataFrame:
    """Adds ``bad_score`` to the rows of ``urls(url, ...)``; ``labelled`` is ``url, bad`` (0 or 1).

    ``labelled`` should be a written table: a filter on a label that is computed in
    many steps would be planned through all of them.
    """
    known = with_features(labelled.filter("bad is not null").select("url", F.col("bad").cast("double")))
    known = materialize(known.withColumn("fold", F.pmod(F.xxhash64("url_text"), F.lit(FOLDS)).cast("int")), "labelled")
    tables, mean = suffix_rates(known)
    n = known.count()
    judged = with_features(urls).withColumn("fold", F.lit(None).cast("int"))
    rows = _with_rates(judged, tables, mean, training.smoothing).drop("fold")
    if n == 0 or mean in (0.0, 1.0):
        return rows.withColumn("bad_score", F.lit(float(mean)))
    per_million = min(1_000_000, int(1_000_000 * training.max_labelled / n))
    chosen = known.filter(F.pmod(F.xxhash64("url_text"), F.lit(1_000_000)) < per_million)
    # a fifth of what is learned from tells when further trees no longer help
    checked = (F.pmod(F.xxhash64("url_text", F.lit("checked")), F.lit(5)) == 0).alias("checked")
    sample = materialize(_with_rates(chosen, tables, mean, training.smoothing).select("features", "bad", checked), "sample")
    kinds = sample.agg(F.countDistinct(F.when(~F.col("checked"), F.col("bad"))).alias("n"), F.max("checked").alias("any")).first()
    if kinds.n < 2:
        return rows.withColumn("bad_score", F.lit(float(mean)))
    learner = GBTClassifier(
        featuresCol="features",
        labelCol="bad",
        **({"validationIndicatorCol": "checked"} if kinds.any else {}),
        maxIter=training.trees,
        maxDepth=training.depth,
        stepSize=training.step,
        minInstancesPerNode=training.least_node,
        seed=training.seed,
    )
    model = learner.fit(sample)
    return model.transform(rows).withColumn("bad_score", vector_to_array("probability")[1])


def judge_urls(urls: DataFrame, labelled: DataFrame, rules: list[Rule], training: Training = Training()) -> DataFrame:
    """``urls`` with ``host, path, rule, verdict, bad_score``.

    The verdict is the longest fitting rule's, else block where the score reaches
    the threshold. The trees learn from labelled URLs that no rule fits, as they
    judge no other. Columns of ``urls`` with these names give way.
    """
    ruled_out = matched_rule(url_host(F.col("url")), url_path(F.col("url")), rules).isNull()
    labelled = labelled.filter(ruled_out)
    made = ["host", "path", "rule", "verdict", "bad_score"]
    carried = [c for c in urls.columns if c not in made]
    rows = urls.select(F.col("url"), F.struct(*[F.col(c) for c in carried]).alias("carried"))
    scored = score_urls(rows, labelled, training)
    ruled = scored.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
    learned = F.when(F.col("bad_score") >= training.threshold, "block").otherwise("allow")
    return ruled.select(
        *[F.col("carried")[c].alias(c) for c in carried],
        "host",
        "path",
        F.col("_rule.text").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), learned).alias("verdict"),
        "bad_score",
    )
