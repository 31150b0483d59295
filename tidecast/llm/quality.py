"""Quality classifier: a sparse rule ensemble compiled into Spark column expressions.

1. ``with_statistics`` computes statistics of each text with built-in functions.
2. A random forest of shallow trees is fitted to labelled rows; every path from a root to a
   node below it becomes a conjunctive rule over the statistics.
3. A lasso logistic regression weighs the rules; most weights become zero.
4. ``score_column`` writes the rules that are left as one column expression, so scoring is a
   projection in the scan's own stage.

The fit uses at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash of their id,
whatever the input's size; scoring covers all rows.  Only statistics of the text enter a score.

Defined results: a null or empty text has zero for every statistic and a score like any other;
labels that are null or of another id are not used, of repeated labels of one id the largest
holds; with no label of one of the classes the score is the smoothed share of good labels
(0.5 without labels); repeated documents are scored alike; an empty table gives no rows; other
columns are kept (``with_score``).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from . import _shared as S

SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, LASSO = 12, 3, 1e-3

STATISTICS = ("chars", "words", "word_chars", "distinct_words", "repeated_words", "short_words", "lines", "distinct_lines",
              "capitals", "digits", "commas", "ends", "bangs", "bars", "signs")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_s_`` of doubles, one field for each of STATISTICS.

    Words are split at white space; shares are per word or per character."""
    t = F.trim(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(" \t\n\r"))
    d = docs.withColumn("_t_", t)
    d = d.withColumn("_w_", F.when(F.col("_t_") == "", F.array().cast("array<string>")).otherwise(F.split("_t_", r"\s+")))
    d = d.withColumn("_l_", F.when(F.col("_t_") == "", F.array().cast("array<string>")).otherwise(F.split("_t_", "\n")))
    n, w, lines = F.length("_t_"), F.size("_w_"), F.size("_l_")

    def share(x: Column, of: Column) -> Column:
        return F.when(of > 0, x / of).otherwise(F.lit(0.0)).cast("double")

    def count(sign: str) -> Column:
        return n - F.length(F.replace(F.col("_t_"), F.lit(sign), F.lit("")))

    values = {
        "chars": n.cast("double"), "words": w.cast("double"), "word_chars": share(n - w + 1, w),
        "distinct_words": share(F.size(F.array_distinct("_w_")), w),
        # neighbours that are equal
        "repeated_words": share(F.size(F.filter(F.arrays_zip(F.col("_w_").alias("a"), F.slice(F.col("_w_"), 2, F.greatest(w, F.lit(1))).alias("b")), lambda x: x["a"] == x["b"])), w),
        "short_words": share(F.size(F.filter("_w_", lambda x: F.length(x) <= 3)), w),
        "lines": share(lines, w), "distinct_lines": share(F.size(F.array_distinct("_l_")), lines),
        "capitals": share(F.regexp_count("_t_", F.lit(r"\p{Lu}")), n), "digits": share(F.regexp_count("_t_", F.lit("[0-9]")), n),
        "commas": share(count(","), w), "ends": share(count("."), w), "bangs": share(count("!"), w), "bars": share(count("|"), w),
        "signs": share(F.regexp_count("_t_", F.lit(r"[^\p{L}\p{N}\s.,;:!?'()|-]")), n),
    }
    return d.withColumn("_s_", F.struct(*[values[k].alias(k) for k in STATISTICS])).drop("_t_", "_w_", "_l_")


class Rules:
    """Weighted conjunctions: each rule is a tuple of (statistic, at most?, threshold)."""

    def __init__(self, rules: list[tuple], weights: list[float], intercept: float):
        self.rules, self.weights, self.intercept = rules, weights, intercept

    @staticmethod
    def column(rule: tuple) -> Column:
        tests = [(F.col(f"_s_.{s}") <= v) if low else (F.col(f"_s_.{s}") > v) for s, low, v in rule]
        return reduce(lambda a, b: a & b, tests)

    def score_column(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            if weight:
                total = total + F.when(self.column(rule), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _paths(tree) -> list[tuple]:
    """All conjunctions of a fitted tree, one per node below the root."""
    out = []

    def walk(node, path):
        if path:
            out.append(tuple(sorted(path)))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], split.threshold()
        walk(node.leftChild(), [*path, (name, True, at)])
        walk(node.rightChild(), [*path, (name, False, at)])

    walk(tree._call_java("rootNode"), [])
    return out


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS,
        skip_held_out: bool = True) -> Rules:
    """Fit the rules to labelled documents, without the held-out fifth of the ids."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    known = (labels.select(F.col(f"`{doc_id}`").alias("_id_"), F.col(f"`{label}`").cast("int").alias("_y_")).filter("_id_ IS NOT NULL AND _y_ IN (0, 1)")
             .groupBy("_id_").agg(F.max("_y_").alias("_y_")))
    if skip_held_out:
        known = known.filter(~held_out("_id_"))
    # a bounded sample that does not depend on how the table is cut
    known = known.orderBy(F.xxhash64("_id_"), "_id_").limit(sample_rows)
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id_"), F.col(f"`{text}`").alias("text")).join(F.broadcast(known), "_id_").dropDuplicates(["_id_"])
    vector = array_to_vector(F.array(*[F.col(f"_s_.{s}") for s in STATISTICS]))
    rows = S.table(with_statistics(rows).select("_id_", F.col("_y_").cast("double").alias("label"), "_s_").coalesce(4), "quality-sample").select("*", vector.alias("features"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("good")).first()
    if size["good"] in (0, size["n"]):
        return _prior(size)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(rows.select("label", "features"))
    rules = sorted({p for t in forest.trees for p in _paths(t)})
    if not rules:   # no statistic tells the classes apart
        return _prior(size)
    fired = rows.select("label", array_to_vector(F.array(*[Rules.column(r).cast("double") for r in rules])).alias("features")).persist()
    model = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=60, standardization=True).fit(fired)
    fired.unpersist()
    return Rules(rules, [float(w) for w in model.coefficients], float(model.intercept))


def _prior(size) -> Rules:
    p = (size["good"] + 1) / (size["n"] + 2)
    return Rules([], [], math.log(p / (1 - p)))


def with_score(docs: DataFrame, rules: Rules, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score, 0 to 1 (higher: a good label is likelier), in place of a column
    that has its name."""
    scored = with_statistics(docs.drop(name), text).withColumn("_score_", rules.score_column()).drop("_s_")
    return scored.withColumnRenamed("_score_", name)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    rules = fit(docs, labels)
    return with_score(docs, rules, name="_quality_").filter(F.col("_quality_") >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract rows of op3 over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_score(docs.select("doc_id", "text"), rules).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
