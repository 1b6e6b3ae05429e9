"""Classifiers of candidate pairs on named feature columns. All but the naive Bayes in SQL form are Spark ML estimators.

Deviations, as Spark ML has no counterpart: the multi-layer perceptron has sigmoid layers and no batch normalisation
(early stopping by `patience`); the kernel machine is a linear one over random Fourier features; a single-layer perceptron is a
logistic regression without penalty.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from typing import Any

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import Binarizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMES = {
    "naive_bayes": "nb", "logistic_regression": "lr", "support_vector_machines": "svm", "linear_support_vector_machines": "lsvm", "random_forest": "rf", "single_layer_perceptron": "slp",
    "multi_layer_perceptron": "mlp", "voting_classifier": "vc", "gated_classifier": "gc", "stacked_classifier": "sc",
}
# Settings that results depend on, and the grids over them.
DEFAULTS = {
    "nb": {"alpha": 1e-4, "binarize": 0.2}, "lr": {"tol": 1e-3, "C": 1.0, "max_iter": 100}, "lsvm": {"tol": 1e-3, "C": 1.0, "max_iter": 1000}, "svm": {"C": 1.0, "gamma": 1.0, "components": 128, "max_iter": 100},
    "rf": {"n_estimators": 500, "criterion": "entropy", "max_features": "all", "bootstrap": True}, "slp": {"max_iter": 1000}, "mlp": {"hidden": [128, 32], "max_iter": 200, "patience": 0, "step": 10, "validation": 0.33},
    "vc": {"voting": "soft"}, "gc": {"folds": 2, "meta": "slp"}, "sc": {"folds": 2, "meta": "slp"},
}
GRIDS = {
    "nb": {"alpha": [1e-4, 1e-3, 1e-2, 0.1, 1], "binarize": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]}, "lr": {"tol": [1e-3, 1e-4, 1e-5], "C": [0.01, 0.1, 1.0, 10, 100], "max_iter": [100, 200]},
    "lsvm": {"tol": [1e-3, 1e-4, 1e-5], "C": [0.01, 0.1, 1.0, 10, 100]}, "svm": {"C": [0.01, 0.1, 1.0, 10], "gamma": [0.1, 1.0, 10.0]},
    "rf": {"n_estimators": [100, 200, 350, 500], "criterion": ["gini", "entropy"], "max_features": ["sqrt", "log2", "all"]}, "slp": {"max_iter": [100, 1000, 2000, 3000]},
    "mlp": {"hidden": [[128, 32], [256, 128, 32], [128, 32, 32]], "max_iter": [100, 200]},
}
MEMBERS = ("nb", "lr", "rf", "slp", "mlp")
SEED = 1269


#: Classifiers of one's own: a function of parameters, feature column and label column that gives a Spark ML estimator.
OWN: dict[str, Callable[[dict, str, str], Any]] = {}


def register(kind: str, make: Callable[[dict, str, str], Any], **defaults) -> None:
    """A further kind for train(), with its parameters and their defaults."""
    if kind in DEFAULTS and kind not in OWN:
        raise ValueError(f"{kind} is built in")
    OWN[kind], DEFAULTS[kind] = make, defaults


def short_name(name: str) -> str:
    out = NAMES.get(name, name)
    if out not in DEFAULTS:
        raise ValueError(f"no such classifier: {name}; there are {sorted(NAMES)} and {sorted(DEFAULTS)}")
    return out


def options(args: list[str]) -> dict[str, float | str]:
    """key=value arguments; numbers as numbers."""
    out: dict[str, float | str] = {}
    for a in args:
        key, eq, value = a.partition("=")
        if not eq or not key:
            raise ValueError(f"not key=value: {a}")
        try:
            out[key.lstrip("-")] = float(value)
        except ValueError:
            out[key.lstrip("-")] = value
    return out


def padded(df: DataFrame, features: list[str]) -> DataFrame:
    """df with every feature by its name; absent or null ones are 0.0."""
    return df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) if f in df.columns else F.lit(0.0) for f in features})


class Model:
    """A fitted classifier: score(df) adds `confidence` (0 to 1) and keeps the other columns."""

    def __init__(self, kind: str, features: list[str], fitted, params: dict):
        self.kind, self.features, self.fitted, self.params = kind, features, fitted, params

    def score(self, df: DataFrame, out: str = "confidence") -> DataFrame:
        rows = padded(df, self.features)
        if self.kind in ("vc", "gc", "sc"):
            return self._ensemble(rows, out).select(*df.columns, out)
        done = self.fitted.transform(rows)
        # a linear machine has no probabilities: its prediction is the score
        made = F.col("prediction") if self.kind in ("lsvm", "svm") else vector_to_array("probability")[1]
        return done.withColumn(out, made.cast("double")).select(*df.columns, out)

    def _ensemble(self, rows: DataFrame, out: str) -> DataFrame:
        layers, meta = self.fitted
        for i, layer in enumerate(layers):
            for j, m in enumerate(layer):
                rows = m.score(rows, f"layer{i}_{j}")
        last = [F.col(f"layer{len(layers) - 1}_{j}") for j in range(len(layers[-1]))]
        if meta is not None:
            return meta.score(rows, out)
        votes = [F.when(c > 0.5, 1.0).otherwise(0.0) for c in last] if self.params.get("voting") == "hard" else last
        mean = reduce(lambda a, b: a + b, votes) / len(votes)
        return rows.withColumn(out, (mean > 0.5).cast("double") if self.params.get("voting") == "hard" else mean)

    def save(self, path: str) -> None:
        spark = _spark()
        about = {"kind": self.kind, "features": self.features, "params": self.params}
        if self.kind in ("vc", "gc", "sc"):
            layers, meta = self.fitted
            about |= {"layers": list(map(len, layers)), "meta": meta is not None}
            for i, layer in enumerate(layers):
                for j, m in enumerate(layer):
                    m.save(f"{path}/layer{i}_{j}")
            if meta is not None:
                meta.save(f"{path}/meta")
        else:
            self.fitted.write().overwrite().save(f"{path}/model")
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @staticmethod
    def load(path: str) -> Model:
        about = json.loads(_spark().read.text(f"{path}/about").first()[0])
        if "layers" in about:
            layers = [[Model.load(f"{path}/layer{i}_{j}") for j in range(n)] for i, n in enumerate(about["layers"])]
            fitted = (layers, Model.load(f"{path}/meta") if about["meta"] else None)
        else:
            fitted = PipelineModel.load(f"{path}/model")
        return Model(about["kind"], about["features"], fitted, about["params"])


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def train(kind: str, rows: DataFrame, features: list[str], label: str = "label", **params) -> Model:
    """rows: the features and a 0/1 label. Unknown parameters are refused."""
    kind = short_name(kind)
    if unknown := set(params) - set(DEFAULTS[kind]) - {"members"}:
        raise ValueError(f"{kind} has no {sorted(unknown)}")
    p = {**DEFAULTS[kind], **params}
    data = padded(rows, features).withColumn(label, F.col(label).cast("double"))
    if kind in ("vc", "gc", "sc"):
        return _train_ensemble(kind, data, features, label, p)
    stages, inputs = [], list(features)
    if kind == "nb":
        inputs = [f"bin_{f}" for f in features]
        stages.append(Binarizer(threshold=float(p["binarize"]), inputCols=features, outputCols=inputs))
    if kind == "svm":
        from pyspark.ml.feature import SQLTransformer

        made = ", ".join(f"{_sql(features, i, int(p['components']), float(p['gamma']))} AS rff{i}" for i in range(int(p["components"])))
        stages.append(SQLTransformer(statement=f"SELECT *, {made} FROM __THIS__"))
        inputs = [f"rff{i}" for i in range(int(p["components"]))]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features_vector"))
    common = {"featuresCol": "features_vector", "labelCol": label}
    n = 1.0
    if kind in ("lr", "lsvm", "svm"):
        n = max(1, rows.count())
    if kind == "mlp" and int(p["patience"]):
        return Model(kind, list(features), _early_stopped(Pipeline(stages=stages).fit(data), data, features, label, p), p)
    made = {
        **{k: (lambda f=f: f(p, "features_vector", label)) for k, f in OWN.items()},
        "nb": lambda: NaiveBayes(modelType="bernoulli", smoothing=float(p["alpha"]), **common),
        "lr": lambda: LogisticRegression(regParam=1 / (float(p["C"]) * n), tol=float(p["tol"]), maxIter=int(p["max_iter"]), **common),
        "slp": lambda: LogisticRegression(regParam=0.0, maxIter=int(p["max_iter"]), **common),
        "lsvm": lambda: LinearSVC(regParam=1 / (float(p["C"]) * n), tol=float(p["tol"]), maxIter=int(p["max_iter"]), **common),
        "svm": lambda: LinearSVC(regParam=1 / (float(p["C"]) * n), maxIter=int(p["max_iter"]), **common),
        "rf": lambda: RandomForestClassifier(numTrees=int(p["n_estimators"]), impurity=str(p["criterion"]), featureSubsetStrategy=str(p["max_features"]), bootstrap=bool(p["bootstrap"]), seed=SEED, **common),
        "mlp": lambda: MultilayerPerceptronClassifier(layers=[len(features), *map(int, p["hidden"]), 2], maxIter=int(p["max_iter"]), seed=SEED, **common),
    }[kind]()
    return Model(kind, list(features), Pipeline(stages=[*stages, made]).fit(data), p)


def _early_stopped(prepared: PipelineModel, data: DataFrame, features: list[str], label: str, p: dict) -> PipelineModel:
    """The perceptron in rounds of `step` iterations, each from the weights of the last; it ends when the loss on held-out
    rows (a share `validation`, by a hash of the row) hasn't fallen for `patience` iterations, and the best round stays."""
    from linkforge.operators.closure import cut

    keys = [c for c in ("qid", "tid") if c in data.columns] or list(features)
    rows = cut(prepared.transform(data).withColumn("held", F.pmod(F.xxhash64(*keys), F.lit(1000)) < 1000 * float(p["validation"])))
    own, held = rows.where("not held"), rows.where("held")
    if held.isEmpty() or own.isEmpty():
        own = held = rows
    chance = F.greatest(F.lit(1e-12), F.element_at(vector_to_array("probability"), F.col(label).cast("int") + 1))
    best, weights, since = None, None, 0
    for _ in range(0, int(p["max_iter"]), int(p["step"])):
        m = MultilayerPerceptronClassifier(layers=[len(features), *map(int, p["hidden"]), 2], maxIter=int(p["step"]), seed=SEED, featuresCol="features_vector", labelCol=label)
        model = (m.setInitialWeights(weights) if weights is not None else m).fit(own)
        weights, loss = model.weights, model.transform(held).agg(F.avg(-F.log(chance))).first()[0]
        if best is None or loss < best[0]:
            best, since = (loss, model), 0
        else:
            since += int(p["step"])
            if since >= int(p["patience"]):
                break
    return PipelineModel([*prepared.stages, best[1]])


def _sql(features: list[str], i: int, n: int, gamma: float) -> str:
    """A random Fourier feature of a Gaussian kernel: inner products approximate exp(-gamma |x - y|^2)."""
    r = np.random.default_rng(SEED)
    w, b = r.normal(0, np.sqrt(2 * gamma), (n, len(features))), r.uniform(0, 2 * np.pi, n)
    return f"cos({' + '.join(f'{float(w[i, j])!r}D * `{f}`' for j, f in enumerate(features))} + {float(b[i])!r}D) * {float(np.sqrt(2 / n))!r}D"


def _train_ensemble(kind: str, data: DataFrame, features: list[str], label: str, p: dict) -> Model:
    """Voting: mean or majority. Gated: one layer, whose out-of-fold scores train the meta classifier. Stacked: two layers."""
    from linkforge.operators.closure import cut
    from linkforge.operators.evaluate import folds

    members = [(m, {}) if isinstance(m, str) else m for m in p.pop("members", MEMBERS)]
    fit = lambda rows, cols: [train(k, rows, cols, label, **a) for k, a in members]
    if kind == "vc":
        return Model(kind, list(features), ([fit(data, features)], None), p)
    layers, rows, cols = [], data, list(features)
    for i in range(1 if kind == "gc" else 2):
        # by the pairs' ids: equal vectors would tie
        keys = [c for c in ("qid", "tid") if c in rows.columns] or cols
        dealt = cut(folds(rows, int(p["folds"]), keys, label, "layer_fold"))
        parts = []
        for k in range(int(p["folds"])):
            part = dealt.where(F.col("layer_fold") == k)
            for j, m in enumerate(fit(dealt.where(F.col("layer_fold") != k), cols)):
                part = m.score(part, f"layer{i}_{j}")
            parts.append(part)
        layers.append(fit(rows, cols))
        rows = reduce(DataFrame.unionByName, parts).drop("layer_fold")
        cols = [f"layer{i}_{j}" for j in range(len(members))]
    return Model(kind, list(features), (layers, train(str(p["meta"]), rows, cols, label)), p)


def naive_bayes_table(rows: DataFrame, features: list[str], label: str = "label", alpha: float = 1e-4, binarize: float = 0.2) -> DataFrame:
    """Bernoulli naive Bayes in closed form: per class and feature the log probabilities of 1 and 0, and the log prior."""
    bits = padded(rows, features).select(F.col(label).cast("int").alias("label"), *[(F.col(f) > binarize).cast("long").alias(f) for f in features])
    counts = bits.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f) for f in features])
    total = counts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("k"))
    long = counts.join(F.broadcast(total)).unpivot(["label", "n", "total", "k"], features, "feature", "ones")
    p = (F.col("ones") + alpha) / (F.col("n") + 2 * alpha)
    return long.select("label", "feature", F.log(F.col("n") / F.col("total")).alias("prior"), F.log(p).alias("one"), F.log(1 - p).alias("zero"))


def naive_bayes_score(rows: DataFrame, keys: list[str], table: DataFrame, features: list[str], binarize: float = 0.2) -> DataFrame:
    """keys and confidence, by the table of naive_bayes_table: a row per class and feature, which become constants of one
    projection, so no row is moved."""
    known: dict[int, dict] = {}
    for r in table.collect():
        known.setdefault(int(r["label"]), {"prior": r["prior"]})[r["feature"]] = (r["one"], r["zero"])

    def total(label: int) -> Column:
        parts = [F.when(F.col(f) > binarize, F.lit(known[label][f][0])).otherwise(F.lit(known[label][f][1])) for f in features]
        return reduce(lambda a, b: a + b, parts) + F.lit(known[label]["prior"])

    if not {0, 1} <= {*known}:
        score = F.lit(1.0 if 1 in known else 0.0)
    else:
        score = 1 / (1 + F.exp(total(0) - total(1)))
    return padded(rows, features).select(*keys, score.alias("confidence"))


def unsupervised(rows: DataFrame, features: list[str], binarize: float = 0.5, rounds: int = 50, start: float = 0.1) -> tuple[DataFrame, dict]:
    """Expectation maximisation of a two-class mixture of independent binary features, without labels.

    rows with `confidence`, and the fitted parameters. Only the counts of feature patterns reach the driver: at most 2 to
    the number of features, which is bounded at 16.
    """
    if not 0 < len(features) <= 16:
        raise ValueError("1 to 16 features")
    bits = reduce(lambda a, b: a + b, [F.when(F.coalesce(F.col(f), F.lit(0.0)) > binarize, 1 << i).otherwise(0) for i, f in enumerate(features)])
    coded = rows.withColumn("pattern", bits)
    counts = [(r["pattern"], r["count"]) for r in coded.groupBy("pattern").count().collect()]
    x = np.array([[p >> i & 1 for i in range(len(features))] for p, _ in counts], dtype=float).reshape(-1, len(features))
    n = np.array([c for _, c in counts], dtype=float)
    prior, m, u = start, np.full(len(features), 0.9), np.full(len(features), 0.1)
    odds = np.zeros(len(n))
    for _ in range(rounds if len(n) else 0):
        yes = np.log(prior) + x @ np.log(m) + (1 - x) @ np.log(1 - m)
        no = np.log(1 - prior) + x @ np.log(u) + (1 - x) @ np.log(1 - u)
        odds = 1 / (1 + np.exp(no - yes))
        w = n * odds
        clip = lambda v: np.clip(v, 1e-6, 1 - 1e-6)
        prior = float(clip(w.sum() / n.sum()))
        m, u = clip((w[:, None] * x).sum(0) / max(w.sum(), 1e-9)), clip(((n - w)[:, None] * x).sum(0) / max((n - w).sum(), 1e-9))
    table = F.create_map(*[F.lit(v) for (p, _), o in zip(counts, odds.tolist(), strict=True) for v in (p, o)]) if counts else F.lit(None)
    scored = coded.withColumn("confidence", F.try_element_at(table, F.col("pattern")) if counts else F.lit(0.0)).drop("pattern")
    return scored, {"prior": prior, "match": dict(zip(features, m.tolist(), strict=True)), "rest": dict(zip(features, u.tolist(), strict=True))}
