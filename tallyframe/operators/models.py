"""Model training and search on Spark ML. Fits are Spark jobs; the driver holds only scores and parameters."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.ordered import lookup_join
from tallyframe.operators.evaluation import auc, regression_metrics, risk_level, roc_points
from tallyframe.operators.splits import stratified_folds

SEED = 42


def assembler(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")


def logistic(cols: Sequence[str], label: str, reg: float = 0.01, weight: str | None = None) -> Pipeline:
    lr = LogisticRegression(featuresCol="scaled", labelCol=label, regParam=reg, maxIter=50)
    if weight:
        lr = lr.setWeightCol(weight)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True)
    return Pipeline(stages=[assembler(cols), scaler, lr])


def forest(cols: Sequence[str], label: str, trees: int = 100, depth: int = 5, weight: str | None = None,
           subset: str = "sqrt") -> Pipeline:
    rf = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy=subset, seed=SEED)
    if weight:
        rf = rf.setWeightCol(weight)
    return Pipeline(stages=[assembler(cols), rf])


def boosted(cols: Sequence[str], label: str, rounds: int = 20, depth: int = 3, step: float = 0.1, subsample: float = 1.0) -> Pipeline:
    return Pipeline(stages=[assembler(cols), GBTClassifier(
        labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=subsample, seed=SEED)])


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (k · n_class), from class counts joined back (no window over a hot class)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    tot = c.agg(F.struct(F.sum("__c").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return lookup_join(df, c, [label]).withColumn("__t", tot).withColumn(
        name, F.col("__t.n") / (F.col("__t.k") * F.col("__c"))).drop("__c", "__t")


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds the probability of class 1 (4 places), the decision and the risk level."""
    p = F.round(vector_to_array("probability")[1], 4)
    return model.transform(df).withColumn("probability_1", p).withColumns({
        "decision": (F.col("probability_1") >= threshold).cast("int"), "risk": risk_level(F.col("probability_1"))})


def classifier_metrics(predicted: DataFrame, label: str) -> dict[str, float]:
    """Accuracy and area under the ROC curve of a transformed frame (two classes)."""
    p = predicted.select(F.col(label).cast("int").alias("y"), "prediction", F.round(vector_to_array("probability")[1], 9).alias("s"))
    acc = p.agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).first()[0]
    area = auc(roc_points(p, "y", "s")).first()[0]
    return {"accuracy": float(acc or 0.0), "auc": float(area if area is not None else float("nan"))}


def cross_validate(df: DataFrame, make: Callable[[], Estimator], label: str, fold: str = "fold",
                   parallelism: int = 4) -> list[dict]:
    """One fit per fold; the fits run from driver threads, each is a Spark job of its own."""
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())

    def run(k):
        model = make().fit(df.where(F.col(fold) != k))
        return {"fold": int(k), **classifier_metrics(model.transform(df.where(F.col(fold) == k)), label)}

    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(run, folds))


def with_summary(scores: list[dict], metric: str) -> dict[str, float]:
    v = np.array([s[metric] for s in scores], float)
    return {"mean": float(np.nanmean(v)), "std": float(np.nanstd(v))}


def score_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = list(rows[0])
    kind = lambda v: "string" if isinstance(v, str) else "int" if isinstance(v, int) and not isinstance(v, bool) else "double"
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} {kind(rows[0][n])}" for n in names))


def importances(model: PipelineModel, cols: Sequence[str], spark: SparkSession) -> DataFrame:
    imp = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(c, float(i)) for c, i in zip(cols, imp)], "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def recursive_elimination(df: DataFrame, cols: Sequence[str], label: str, keep: int, trees: int = 10) -> DataFrame:
    """Drop the least important feature, refit, until ``keep`` remain. Rank 1 marks the kept ones."""
    left, ranks = list(cols), {}
    while len(left) > keep:
        imp = forest(left, label, trees, 4).fit(df).stages[-1].featureImportances.toArray()
        worst = min(range(len(left)), key=lambda i: (imp[i], left[i]))
        ranks[left.pop(worst)] = len(left) - keep + 2
    rows = [(c, 1, True) for c in left] + [(c, r, False) for c, r in ranks.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, rank int, kept boolean")


# -- linear models -------------------------------------------------------------------------------

def linear_models(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str, ridge: float = 1e5, lasso: float = 1e4,
                  elastic: tuple[float, float] = (1e4, 0.5)) -> DataFrame:
    """OLS, ridge, lasso and elastic net on scaled features, with their test metrics.

    The penalty of a ridge with strength alpha is alpha · std(y) / n in Spark's scaling.
    """
    n, sd = train.agg(F.count(label), F.stddev_pop(label)).first()
    settings = {
        "OLS": (0.0, 0.0), "Ridge": (ridge * sd / n, 0.0), "Lasso": (lasso, 1.0), "ElasticNet": elastic}
    prep = Pipeline(stages=[assembler(cols), StandardScaler(inputCol="features", outputCol="scaled", withMean=True)]).fit(train)
    tr, te = prep.transform(train).select("scaled", label).persist(), prep.transform(test).select("scaled", label)
    out = None
    for name, (reg, mix) in settings.items():
        lr = LinearRegression(featuresCol="scaled", labelCol=label, regParam=float(reg), elasticNetParam=mix,
                              standardization=False, solver="normal" if mix == 0 else "l-bfgs")
        m = regression_metrics(lr.fit(tr).transform(te), label, "prediction").withColumn("model", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out


def ridge_cv(df: DataFrame, cols: Sequence[str], label: str, alphas: Sequence[float], fold: str = "fold") -> DataFrame:
    """Mean held-out squared error per alpha, ``best`` marked.

    One aggregate gives the cross products per fold; every fold and alpha is
    solved from those, so the data is read once whatever the grid.
    """
    k = len(cols)
    x = ["1", *cols]
    d = df.select(fold, F.col(label).cast("double").alias("__y"), F.lit(1.0).alias("x0"),
                  *[F.col(c).cast("double").alias(f"x{i + 1}") for i, c in enumerate(cols)]).na.drop()
    m = len(x)
    rows = d.groupBy(fold).agg(
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"a{i}_{j}") for i in range(m) for j in range(i, m)],
        *[F.sum(F.col(f"x{i}") * F.col("__y")).alias(f"b{i}") for i in range(m)], F.sum(F.col("__y") * F.col("__y")).alias("yy")).collect()
    parts = [(np.array([[r[f"a{min(i, j)}_{max(i, j)}"] for j in range(m)] for i in range(m)], float),
              np.array([r[f"b{i}"] for i in range(m)], float), r["yy"]) for r in rows]
    total = [sum(p[i] for p in parts) for i in range(3)]

    def held_out(alpha):
        errs = []
        for a, b, yy in parts:
            ta, tb = total[0] - a, total[1] - b
            n, s = ta[0, 0], ta[0, 1:]
            cov = ta[1:, 1:] - np.outer(s, s) / n
            sd = np.sqrt(np.diag(cov) / n)
            sd[sd == 0] = 1.0
            z, zy = cov / np.outer(sd, sd), (tb[1:] - s * tb[0] / n) / sd
            w = np.linalg.solve(z + alpha * np.eye(k), zy) / sd
            beta = np.concatenate([[tb[0] / n - w @ (s / n)], w])
            errs.append((yy - 2 * beta @ b + beta @ a @ beta) / a[0, 0])
        return float(np.mean(errs))

    scores = [(float(al), held_out(al)) for al in alphas]
    best = min(scores, key=lambda r: r[1])[0]
    return df.sparkSession.createDataFrame([(a, e, a == best) for a, e in scores], "alpha double, mse double, best boolean")


# -- search --------------------------------------------------------------------------------------

def random_search(df: DataFrame, cols: Sequence[str], label: str, draws: int = 20, folds: int = 3, key: str = "doc_id",
                  grid: dict[str, Sequence] | None = None) -> DataFrame:
    """Random draws without repetition from a forest grid, scored by cross-validated AUC."""
    grid = grid or {"trees": [5, 10, 20], "depth": [2, 4, 6], "min_rows": [1, 2, 5], "subset": ["sqrt", "log2"]}
    names = list(grid)
    rng = random.Random(SEED)
    every = [dict(zip(names, c)) for c in __import__("itertools").product(*grid.values())]
    picks = rng.sample(every, min(draws, len(every)))
    d = stratified_folds(df, key, label, folds).persist()

    def make(p):
        pipe = forest(cols, label, p["trees"], p["depth"], subset=p["subset"])
        pipe.getStages()[-1].setMinInstancesPerNode(p["min_rows"])
        return pipe

    rows = []
    for i, p in enumerate(picks):
        s = with_summary(cross_validate(d, lambda: make(p), label), "auc")
        rows.append({"draw": i, **p, "auc_mean": s["mean"], "auc_std": s["std"]})
    d.unpersist()
    return score_table(df.sparkSession, rows).withColumn("best", F.col("auc_mean") == max(r["auc_mean"] for r in rows))


def model_search(df: DataFrame, cols: Sequence[str], label: str, trials: int = 10, folds: int = 3, key: str = "doc_id",
                 budget_seconds: float | None = None, objective: Callable[[str, dict, DataFrame], float] | None = None) -> DataFrame:
    """Random search over model family and parameters; a trial log with the best score so far.

    The deadline is looked at between fits. ``objective(family, params, frame)``
    may replace the cross-validated AUC.
    """
    rng = random.Random(SEED)
    log_uniform = lambda a, b: math.exp(rng.uniform(math.log(a), math.log(b)))
    d = stratified_folds(df, key, label, folds).persist()
    started, rows, best = time.monotonic(), [], -math.inf
    for i in range(trials):
        if budget_seconds is not None and rows and time.monotonic() - started > budget_seconds:
            break
        family = rng.choice(["logistic", "forest", "boosted"])
        if family == "logistic":
            p = {"reg": log_uniform(1e-4, 1.0)}
            make = lambda p=p: logistic(cols, label, p["reg"])
        elif family == "forest":
            p = {"trees": rng.randint(5, 15), "depth": rng.randint(2, 5)}
            make = lambda p=p: forest(cols, label, p["trees"], p["depth"])
        else:
            p = {"rounds": rng.randint(3, 8), "depth": rng.randint(2, 3), "step": log_uniform(0.03, 0.3)}
            make = lambda p=p: boosted(cols, label, p["rounds"], p["depth"], p["step"])
        value = objective(family, p, d) if objective else with_summary(cross_validate(d, make, label), "auc")["mean"]
        best = max(best, value)
        rows.append({"trial": i, "family": family, "params": ", ".join(f"{k}={v:.4g}" for k, v in p.items()),
                     "value": value, "best_so_far": best})
    d.unpersist()
    return score_table(df.sparkSession, rows)


def learning_curve(df: DataFrame, make: Callable[[], Estimator], label: str, key: str, sizes: Sequence[float], folds: int = 5) -> DataFrame:
    """Accuracy on the used training rows and on the held-out fold for growing training shares."""
    from tallyframe.operators.ordered import hash_rank

    d = stratified_folds(df, key, label, folds)
    # rank within fold and class by a second hash, so each share keeps the class shares
    d = hash_rank(d.withColumn("__k2", F.concat_ws("#", F.col(key).cast("string"), F.lit("lc"))), "__k2", ["fold", label], "__rn")
    n = d.groupBy("fold", label).agg(F.count(F.lit(1)).alias("__n"))
    d = lookup_join(d, n, ["fold", label]).withColumn("__q", F.col("__rn") / F.col("__n")).drop("__rn", "__n", "__k2").persist()

    def run(job):
        share, k = job
        train = d.where((F.col("fold") != k) & (F.col("__q") <= share))
        model = make().fit(train)
        acc = lambda x: model.transform(x).agg(F.avg((F.col(label) == F.col("prediction")).cast("double"))).first()[0]
        return share, float(acc(train) or 0.0), float(acc(d.where(F.col("fold") == k)) or 0.0)

    with ThreadPoolExecutor(4) as pool:
        res = list(pool.map(run, [(s, k) for s in sizes for k in range(folds)]))
    d.unpersist()
    rows = []
    for s in sizes:
        tr = np.array([r[1] for r in res if r[0] == s])
        va = np.array([r[2] for r in res if r[0] == s])
        rows.append({"share": float(s), "train_mean": float(tr.mean()), "train_std": float(tr.std()), "val_mean": float(va.mean()), "val_std": float(va.std())})
    last = rows[-1]
    verdict = "overfit" if last["train_mean"] - last["val_mean"] > 0.10 else "underfit" if last["val_mean"] < 0.70 else "healthy"
    return score_table(df.sparkSession, rows).withColumn("verdict", F.lit(verdict))


def shapley_values(model: PipelineModel, rows: DataFrame, key: str, cols: Sequence[str], background: dict[str, float],
                   permutations: int = 10) -> DataFrame:
    """Sampled Shapley contributions per row and feature.

    Each row is expanded along random feature orders; one transform scores all
    coalitions, and neighbouring coalitions' differences are averaged.
    """
    rng = random.Random(SEED)
    orders = [rng.sample(range(len(cols)), len(cols)) for _ in range(permutations)]
    spark = rows.sparkSession
    plan = spark.createDataFrame(
        [(p, j, [o[i] for i in range(j)], o[j - 1] if j else None) for p, o in enumerate(orders) for j in range(len(cols) + 1)],
        "p int, j int, used array<int>, added int")
    steps = plan.agg(F.collect_list(F.struct("p", "j", "used", "added"))).scalar()
    d = rows.select(key, *[F.col(c).cast("double").alias(f"__{c}") for c in cols]).withColumn("__s", steps)
    d = d.select("*", F.inline("__s")).select(key, "p", "j", "added", *[
        F.when(F.array_contains("used", i), F.col(f"__{c}")).otherwise(F.lit(float(background[c]))).alias(c) for i, c in enumerate(cols)])
    s = model.transform(d).select(key, "p", "j", "added", vector_to_array("probability")[1].alias("f"))
    # the difference to the coalition before: shift the step number and add with opposite sign
    diff = s.select(key, "p", "j", "added", "f").unionByName(s.select(key, "p", (F.col("j") + 1).alias("j"), F.lit(None).cast("int").alias("added"), (-F.col("f")).alias("f")))
    one = diff.where((F.col("j") > 0) & (F.col("j") <= len(cols))).groupBy(key, "p", "j").agg(F.max("added").alias("i"), F.sum("f").alias("gain"))
    names = F.array(*[F.lit(c) for c in cols])
    return one.groupBy(key, "i").agg(F.avg("gain").alias("contribution")).select(
        key, F.element_at(names, F.col("i") + 1).alias("feature"), "contribution")


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def model_card(spark: SparkSession, model: PipelineModel, name: str, version: str, cols: Sequence[str], metrics: dict[str, float]) -> DataFrame:
    """One JSON row that describes the saved model."""
    row = spark.createDataFrame(
        [(name, version, list(cols), [type(s).__name__ for s in model.stages], {k: float(v) for k, v in metrics.items()})],
        "name string, version string, features array<string>, stages array<string>, metrics map<string,double>")
    return row.select(F.to_json(F.struct("*")).alias("card"))


# -- text ----------------------------------------------------------------------------------------

class SmoothIdf(Estimator):
    """Term weights ``ln((1 + n) / (1 + df)) + 1``; the fitted stage is a plain element-wise product, so pipelines save as usual."""

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self.input, self.output = inputCol, outputCol

    def _fit(self, dataset: DataFrame):
        from pyspark.ml.feature import IDF, ElementwiseProduct

        idf = IDF(inputCol=self.input, outputCol=self.output).fit(dataset).idf.toArray() + 1
        return ElementwiseProduct(inputCol=self.input, outputCol=self.output, scalingVec=Vectors.dense(idf))


VOCABULARY = 100  # terms of a text classifier


def text_stages(size: int = VOCABULARY) -> list:
    """Counts of the most frequent terms, weighted and scaled to unit length as in ``operators.text.tfidf``."""
    from pyspark.ml.feature import CountVectorizer, Normalizer

    return [CountVectorizer(inputCol="terms", outputCol="tf", vocabSize=size, minDF=1.0), SmoothIdf("tf", "weighted"),
            Normalizer(inputCol="weighted", outputCol="features", p=2.0)]


def text_classifier(kind: str, train: DataFrame, label: str, size: int = VOCABULARY) -> Pipeline:
    """Classifier of ``terms`` whose classes are the labels of the training rows, in order; ``predicted`` is the label as text.

    A row with a null label, or one the training rows do not have, is left out of a fit and of a score by label.
    """
    from pyspark.ml.classification import LinearSVC, NaiveBayes, OneVsRest
    from pyspark.ml.feature import IndexToString, StringIndexer

    clf = {
        "logistic": lambda: LogisticRegression(labelCol="label", maxIter=30, regParam=0.01),
        "naive_bayes": lambda: NaiveBayes(labelCol="label", smoothing=0.5),
        "linear_svc": lambda: OneVsRest(classifier=LinearSVC(maxIter=20, regParam=0.01), labelCol="label", parallelism=4),
    }[kind]()
    index = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="skip").fit(train)
    return Pipeline(stages=[index, *text_stages(size), clf, IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels)])


def without_labels(model: PipelineModel) -> PipelineModel:
    """A fitted text classifier for rows that have no label column."""
    return PipelineModel(model.stages[1:])


def accuracy_by_fold(df: DataFrame, make: Callable[[], Estimator], folds: int) -> list[float]:
    def run(k):
        m = make().fit(df.where(F.col("fold") != k))
        return float(m.transform(df.where(F.col("fold") == k)).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0])

    with ThreadPoolExecutor(4) as pool:
        return list(pool.map(run, range(folds)))


def top_coefficients(model: PipelineModel, spark: SparkSession, k: int = 10) -> DataFrame:
    """The terms with the largest weights for every class of a fitted logistic text classifier."""
    index, counts, *_, clf, names = model.stages
    vocab, m = counts.vocabulary, clf.coefficientMatrix.toArray()
    if len(m) == 1:  # two classes share one row
        m = np.vstack([-m, m])
    rows = []
    for i, c in enumerate(names.getLabels()):
        top = sorted(range(len(vocab)), key=lambda j: (-m[i, j], vocab[j]))[:k]
        rows += [(c, r + 1, vocab[j], float(m[i, j])) for r, j in enumerate(top)]
    return spark.createDataFrame(rows, "label string, rank int, term string, weight double")
