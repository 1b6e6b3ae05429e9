"""Folds, metrics, cross-validation, grid search."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkforge.operators.closure import cut

SCHEMA = "fold int, params string, tp long, fp long, fn long, tn long, precision double, recall double, f1 double"


def labelled(pairs: DataFrame, known: DataFrame, keys: tuple[str, str] = ("qid", "tid")) -> DataFrame:
    """pairs with label 1 where they are known links."""
    return pairs.join(known.select(*keys).distinct().withColumn("label", F.lit(1)), list(keys), "left").withColumn("label", F.coalesce("label", F.lit(0)))


def folds(rows: DataFrame, k: int, keys: list[str], label: str = "label", out: str = "fold") -> DataFrame:
    """Stratified folds 0 to k - 1: dealt in turn within each label, in the order of the keys' md5.

    Ranking is by label and hash range, and ranks are offset by the ranges' sizes, so a label isn't one task's work.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
    hashed = rows.withColumn("fold_hash", F.md5(text)).withColumn("fold_range", F.substring("fold_hash", 1, 2))
    sizes = hashed.groupBy(label, "fold_range").agg(F.count(F.lit(1)).alias("fold_n"))
    before = F.coalesce(F.sum("fold_n").over(Window.partitionBy(label).orderBy("fold_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(label, "fold_range", before.alias("fold_before"))
    inside = F.row_number().over(Window.partitionBy(label, "fold_range").orderBy("fold_hash", *keys)) - 1
    return hashed.withColumn("fold_rank", inside).join(F.broadcast(offsets), [label, "fold_range"]).withColumn(out, ((F.col("fold_rank") + F.col("fold_before")) % k).cast("int")).drop("fold_hash", "fold_range", "fold_rank", "fold_before")


def confusion(scored: DataFrame, by: list[str] | None = None, label: str = "label", confidence: str = "confidence", threshold: float = 0.5) -> DataFrame:
    yes, true = F.col(confidence) >= threshold, F.col(label) == 1
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return scored.groupBy(*(by or [])).agg(count(yes & true).alias("tp"), count(yes & ~true).alias("fp"), count(~yes & true).alias("fn"), count(~yes & ~true).alias("tn"))


def metrics(counts: DataFrame) -> DataFrame:
    """precision, recall and f1 of tp, fp, fn; 0.0 where they are undefined."""
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return counts.withColumns({"precision": zero(p), "recall": zero(r), "f1": zero(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))})


def average(per_fold: DataFrame) -> DataFrame:
    """Mean and population deviation over the folds."""
    return per_fold.agg(*[f(c).alias(f"{c}_{n}") for c in ("precision", "recall", "f1") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def cross_validate(kind: str, rows: DataFrame, features: list[str], keys: list[str], k: int = 5, **params) -> DataFrame:
    """Every row's out-of-fold confidence, with its fold."""
    from linkforge.operators.models import train

    # folds() reads its rows twice
    dealt = cut(folds(cut(rows), k, keys))
    parts = [train(kind, dealt.where(F.col("fold") != i), features, **params).score(dealt.where(F.col("fold") == i)) for i in range(k)]
    return reduce(DataFrame.unionByName, parts)


def average_k_fold(kind: str, rows: DataFrame, features: list[str], keys: list[str], k: int = 5, **params) -> DataFrame:
    return average(metrics(confusion(cross_validate(kind, rows, features, keys, k, **params), ["fold"])))


def single_k_fold(kind: str, rows: DataFrame, features: list[str], keys: list[str], k: int = 5, **params) -> DataFrame:
    """Metrics of all folds' predictions pooled."""
    return metrics(confusion(cross_validate(kind, rows, features, keys, k, **params)))


def grid(kind: str) -> list[dict]:
    from linkforge.operators.models import GRIDS, short_name

    options = GRIDS.get(short_name(kind), {})
    return [dict(zip(options, values, strict=True)) for values in product(*options.values())] if options else [{}]


def grid_search(kind: str, rows: DataFrame, features: list[str], keys: list[str], k: int = 5, choices: list[dict] | None = None, parallel: int = 4) -> tuple[dict, DataFrame]:
    """(the parameters with the best mean f1, all results). Ties: the first choice."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    # the fits of several choices run side by side, as each alone leaves executors idle between its rounds
    tried = list(enumerate(grid(kind) if choices is None else choices))
    rows = cut(rows)
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(tried)))) as pool:
        results = list(pool.map(lambda x: (*x, average_k_fold(kind, rows, features, keys, k, **x[1]).first()), tried))
    best = max(results, key=lambda x: (x[2]["f1_mean"], -x[0]))[1]
    table = spark.createDataFrame([(str(p), float(r["f1_mean"]), float(r["f1_std"])) for _, p, r in results], "params string, f1_mean double, f1_std double")
    return best, table


def nested_k_fold(kind: str, rows: DataFrame, features: list[str], keys: list[str], outer: int = 5, inner: int = 5, choices: list[dict] | None = None) -> tuple[DataFrame, list[dict]]:
    """Cross-validation with a grid search within each fold: (metrics per fold, each fold's best parameters)."""
    report, _, found = nested_predictions(kind, rows, features, keys, outer, inner, choices)
    return report, found


def nested_predictions(kind: str, rows: DataFrame, features: list[str], keys: list[str], outer: int = 5, inner: int = 5, choices: list[dict] | None = None) -> tuple[DataFrame, DataFrame, list[dict]]:
    """The same, with every row's prediction by the model that didn't see it."""
    from linkforge.operators.models import train

    dealt = cut(folds(rows, outer, keys, out="outer_fold"))
    parts, found = [], []
    for i in range(outer):
        own = dealt.where(F.col("outer_fold") != i)
        best, _ = grid_search(kind, own, features, keys, inner, choices)
        found.append(best)
        parts.append(train(kind, own, features, **best).score(dealt.where(F.col("outer_fold") == i)))
    scored = cut(reduce(DataFrame.unionByName, parts))
    return metrics(confusion(scored, ["outer_fold"])), scored, found


def describe(scores: DataFrame, by: list[str], column: str = "confidence") -> DataFrame:
    """count, mean, std, min, quartiles and max."""
    c = F.col(column)
    return scores.groupBy(*by).agg(
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.percentile(c, F.lit(0.25)).alias("q25"),
        F.percentile(c, F.lit(0.5)).alias("q50"), F.percentile(c, F.lit(0.75)).alias("q75"), F.max(c).alias("max"),
    )
