"""Model, clustering and text-classifier queries. Model fits are checked by known-answer tests;
clustering measures with closed SQL forms are compared exactly."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tallyframe.operators import clustering as CL, evaluation as E, models as M, splits as SP, text as TX
from tallyframe.plans import views
from tallyframe.plans.registry import query
from tallyframe.plans.text import TOK
from tallyframe.session import checkpointed, shared_path
from tallyframe.sources import sinks
from tallyframe.sources.tables import spread

COLS = views.FEATURE_COLUMNS


def features(t):
    """Features of the labelled documents, written once: every fit then scans a few numeric columns."""
    return checkpointed(views.label_features(t))


def split(t, label="quality"):
    d = SP.stratified_split(features(t), "doc_id", label)
    d = checkpointed(d)
    return d.where("part = 'train'"), d.where("part <> 'train'")


@query("forest_importance")
def forest_importance(t):
    return M.importances(M.forest(COLS, "quality", 100, 5).fit(features(t)), COLS, t.spark)


@query("recursive_elimination")
def recursive_elimination(t):
    return M.recursive_elimination(features(t), COLS, "quality", 3, 5)


@query("feature_set_scores")
def feature_set_scores(t):
    d = features(t).withColumns({
        "chars_per_word": F.try_divide("n_chars", "n_words"), "log_chars": F.log1p("n_chars"), "log_words": F.log1p("n_words"),
        "size_band": F.floor(F.log2(F.greatest("n_chars", F.lit(1.0)))).cast("double")})
    d = checkpointed(SP.stratified_folds(d, "doc_id", "quality", 3))
    sets, rows = {"base": COLS[:2], "+domain": COLS + ["chars_per_word"]}, []
    sets["+log"] = sets["+domain"] + ["log_chars", "log_words"]
    sets["+bins"] = sets["+log"] + ["size_band"]
    for name, cols in sets.items():
        s = M.with_summary(M.cross_validate(d, lambda: M.forest(cols, "quality", 5, 4), "quality"), "accuracy")
        rows.append({"feature_set": name, "n_features": len(cols), "accuracy_mean": s["mean"], "accuracy_std": s["std"]})
    return M.score_table(t.spark, rows)


@query("cross_val_scores")
def cross_val_scores(t):
    d = checkpointed(SP.stratified_folds(features(t), "doc_id", "quality", 5))
    models = {"logistic": lambda: M.logistic(COLS, "quality"), "forest": lambda: M.forest(COLS, "quality", 50, 5)}
    return M.score_table(t.spark, [{"model": n, **r} for n, make in models.items() for r in M.cross_validate(d, make, "quality")])


def priced(t):
    d = t.lineitem.join(t.part.select("p_partkey", "p_retailprice", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    return d.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), "l_quantity", "l_discount", "l_tax", "p_retailprice",
                    F.col("p_size").cast("double").alias("p_size"), "l_extendedprice")


PRICE = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]


@query("linear_models")
def linear_models(t):
    d = priced(t).withColumn("part", F.when(F.pmod(F.xxhash64("id"), F.lit(5)) == 0, "test").otherwise("train"))
    m = M.linear_models(d.where("part = 'train'"), d.where("part = 'test'"), PRICE, "l_extendedprice")
    return m.select("model", "n", "rmse", "mae", "r2")


@query("ridge_cv")
def ridge_cv(t):
    d = priced(t).withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(5)))
    return M.ridge_cv(d, PRICE, "l_extendedprice", [1e3, 1e4, 1e5, 1e6])


def _report(t, pipe, label="quality", weighted=False):
    train, test = split(t, label)
    if weighted:
        train = M.balanced_weights(train, label)
    p = pipe.fit(train).transform(test)
    return E.classification_report(p.withColumn("pred", F.col("prediction").cast("int")), label, "pred").withColumn(
        "auc", F.lit(M.classifier_metrics(p, label)["auc"]))


@query("logistic_balanced")
def logistic_balanced(t):
    return _report(t, M.logistic(COLS, "quality", weight="weight"), weighted=True)


@query("random_forest")
def random_forest(t):
    return _report(t, M.forest(COLS, "quality", 200, 5, weight="weight"), weighted=True)


@query("gradient_boosting")
def gradient_boosting(t):
    train, test = split(t)
    presets = {"shallow": (10, 2, 0.3, 1.0), "standard": (10, 3, 0.1, 1.0), "sampled": (10, 4, 0.1, 0.7)}
    rows = [{"preset": n, **M.classifier_metrics(M.boosted(COLS, "quality", *p).fit(train).transform(test), "quality")} for n, p in presets.items()]
    return M.score_table(t.spark, sorted(rows, key=lambda r: -r["auc"]))


@query("random_search")
def random_search(t):
    return M.random_search(features(t), COLS, "quality", draws=4, folds=3, grid={
        "trees": [5, 10], "depth": [2, 4], "min_rows": [1, 5], "subset": ["sqrt", "log2"]})


@query("model_search")
def model_search(t):
    return M.model_search(features(t), COLS, "quality", trials=4, folds=3)


@query("run_log")
def run_log(t):
    train, test = split(t)
    path = shared_path(t.spark, "runs")
    for name, pipe in {"logistic": M.logistic(COLS, "quality"), "forest": M.forest(COLS, "quality", 10, 4)}.items():
        began = time.time()
        m = M.classifier_metrics(pipe.fit(train).transform(test), "quality")
        row = t.spark.createDataFrame([(name, str(m), m["accuracy"], m["auc"], time.time() - began)],
                                      "run string, params string, accuracy double, auc double, seconds double")
        sinks.append_json_log(row, path)
    return t.spark.read.schema(row.schema).json(path).orderBy(F.desc("auc"), "run")


@query("learning_curve")
def learning_curve(t):
    return M.learning_curve(features(t), lambda: M.forest(COLS, "quality", 5, 3), "quality", "doc_id", [0.2, 0.4, 0.6, 0.8, 1.0], 3)


@query("shap_attribution")
def shap_attribution(t):
    d = features(t)
    model = M.forest(COLS, "quality", 10, 4).fit(d)
    mean = d.agg(*[F.avg(c).alias(c) for c in COLS]).first().asDict()
    return M.shapley_values(model, d.orderBy(F.md5(F.col("doc_id").cast("string"))).limit(50), "doc_id", COLS, mean, 8)


@query("kmeans")
def kmeans(t):
    p = checkpointed(views.customer_points(t))
    curve = CL.kmeans_curve(p, ["x", "y"], range(2, 10))
    sizes = CL.kmeans(p, ["x", "y"], 4).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    a = curve.select(F.lit("curve").alias("part"), "k", "inertia", "silhouette", F.lit(None).cast("long").alias("n"))
    return a.unionByName(sizes.select(F.lit("final").alias("part"), F.col("cluster").alias("k"), F.lit(None).cast("double").alias("inertia"),
                                      F.lit(None).cast("double").alias("silhouette"), "n"))


@query("silhouette", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id, a.label AS la, b.label AS lb, sum(pow(list_distance(a.v, b.v), 2)) AS s, count(*) AS n FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
m AS (SELECT vec_id, max(CASE WHEN la = lb THEN s / n END) AS a, min(CASE WHEN la <> lb THEN s / n END) AS b FROM d GROUP BY 1)
SELECT count(*) AS n, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 7) AS silhouette FROM m""")
def silhouette(t):
    return CL.silhouette(t.embeddings, "embedding", "label").withColumn("silhouette", F.round("silhouette", 7))


@query("dbscan", f"""
WITH RECURSIVE {views.POINTS},
nb AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.4 * 0.4),
co AS MATERIALIZED (SELECT a AS id FROM nb GROUP BY 1 HAVING count(*) >= 5),
ce AS MATERIALIZED (SELECT a, b FROM nb WHERE a IN (SELECT id FROM co) AND b IN (SELECT id FROM co)),
cc(id, lab) AS (SELECT id, id FROM co UNION SELECT ce.b, cc.lab FROM cc JOIN ce ON cc.id = ce.a WHERE cc.lab < ce.b),
cl AS (SELECT id, min(lab) AS cluster FROM cc GROUP BY 1),
bo AS (SELECT nb.a AS id, min(cluster) AS cluster FROM nb JOIN cl ON nb.b = cl.id WHERE nb.a NOT IN (SELECT id FROM co) GROUP BY 1)
SELECT pts.id, coalesce(cl.cluster, bo.cluster, -1) AS cluster, cl.id IS NOT NULL AS is_core FROM pts LEFT JOIN cl ON pts.id = cl.id LEFT JOIN bo ON pts.id = bo.id""")
def dbscan(t):
    return CL.dbscan(views.customer_points(t), "id", "x", "y", 0.4, 5)


@query("hierarchical_clusters")
def hierarchical_clusters(t):
    """Ward clusters of the customers, cut at the height 3 of a hundred points (Ward's heights grow with the root of the rows)."""
    d = checkpointed(views.customer_points(t))
    h = CL.hierarchical(d, ["x", "y"], height=3.0 * (d.count() / 100) ** 0.5)
    return h.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("x"), F.avg("y").alias("y"))


@query("dendrogram")
def dendrogram(t):
    """Merges of the Ward tree from the lowest up: both sides, height and rows."""
    return CL.ward_tree(checkpointed(views.customer_points(t)), ["x", "y"])


@query("model_save_load")
def model_save_load(t):
    """Predictions before saving and after loading agree; the card lists the features."""
    d = features(t)
    model = M.logistic(COLS, "quality").fit(d)
    back = M.save_and_reload(model, shared_path(t.spark, "model"))
    a = M.score(model, d).select("doc_id", F.col("probability_1").alias("before"))
    b = M.score(back, d).select("doc_id", F.col("probability_1").alias("after"))
    card = M.model_card(t.spark, back, "quality", "1.0.0", COLS, M.classifier_metrics(back.transform(d), "quality"))
    return a.join(b, "doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") != F.col("after")).alias("n_different")).withColumn(
        "card", card.scalar())


@query("batch_score")
def batch_score(t):
    d = features(t)
    return M.score(M.logistic(COLS, "quality").fit(d), d).select("doc_id", "probability_1", "decision", "risk")


# -- text ------------------------------------------------------------------------------------------

FOLDS = 5


def texts(t):
    """Documents in folds, with the words and pairs that a vocabulary of any training set can hold."""
    lines = checkpointed(TX.word_lines(spread(t.documents), "text", "doc_id", "lang"))
    folds = checkpointed(SP.stratified_folds(lines, "doc_id", "lang", FOLDS))
    return checkpointed(TX.candidate_terms(folds, M.VOCABULARY, "fold", FOLDS))


@query("text_classifiers")
def text_classifiers(t):
    """Accuracy of three classifiers over five folds, and of the best on the rows it was refitted on."""
    d = texts(t)
    rows = []
    for kind in ("logistic", "naive_bayes", "linear_svc"):
        acc = M.accuracy_by_fold(d, lambda: M.text_classifier(kind, d, "lang"), FOLDS)
        rows.append({"model": kind, "accuracy_mean": sum(acc) / len(acc), "accuracy_min": min(acc)})
    best = max(rows, key=lambda r: r["accuracy_mean"])["model"]
    final = M.text_classifier(best, d, "lang").fit(d).transform(d).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).scalar()
    return M.score_table(t.spark, rows).withColumn("best", F.col("model") == best).withColumn(
        "refit_accuracy", F.when(F.col("best"), final))


def held_out_texts(t):
    """The fifth of the documents that a logistic classifier of the other four fifths has not seen, with its answers."""
    d = texts(t)
    train = d.where("fold <> 0")
    return checkpointed(M.text_classifier("logistic", train, "lang").fit(train).transform(d.where("fold = 0")).select("doc_id", "lang", "predicted"))


@query("text_classifier_report")
def text_classifier_report(t):
    """Precision, recall and F1 of every class on held-out documents."""
    return E.classification_report(held_out_texts(t), "lang", "predicted")


@query("text_confusion")
def text_confusion(t):
    """Held-out documents by true and predicted class."""
    return held_out_texts(t).groupBy("lang", "predicted").agg(F.count(F.lit(1)).alias("n"))


@query("top_coefficients")
def top_coefficients(t):
    d = texts(t)
    return M.top_coefficients(M.text_classifier("logistic", d, "lang").fit(d), t.spark)


@query("classify_new_text")
def classify_new_text(t):
    d = texts(t)
    model = M.without_labels(M.text_classifier("logistic", d, "lang").fit(d))
    model = M.save_and_reload(model, shared_path(t.spark, "text-model"))
    new = TX.listed_terms(TX.word_lines(spread(t.conversations), "text", "conv_id", "turn"), model.stages[0].vocabulary)
    return model.transform(new).select("conv_id", "turn", F.col("predicted").alias("lang"))


PPMI_SQL = f"""
WITH {TOK}, p AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM tk),
c AS (SELECT a.w AS word, b.w AS context, count(*) AS n FROM p a JOIN p b ON a.doc_id = b.doc_id AND a.i <> b.i AND abs(a.i - b.i) <= 2 GROUP BY 1, 2),
m AS (SELECT word, sum(n) AS n FROM c GROUP BY 1), t AS (SELECT sum(n) AS n FROM c),
s AS (SELECT c.word, context, c.n, ln(c.n::DOUBLE * t.n / (x.n::DOUBLE * y.n)) AS pmi FROM c JOIN m x ON c.word = x.word JOIN m y ON c.context = y.word, t)
SELECT word, count(*) AS contexts, CAST(sum(n) AS BIGINT) AS pairs, count(*) FILTER (pmi > 1e-9) AS positive, round(greatest(max(pmi), 0), 6) AS strongest
FROM s GROUP BY 1"""


def contexts(t):
    return TX.word_lines(spread(t.documents), "text", "doc_id").select("doc_id", F.split("words", " ").alias("ws"))


@query("cooccurrence_ppmi", PPMI_SQL)
def cooccurrence_ppmi(t):
    """Contexts of every word within two words of it, and their strongest association."""
    c = TX.ppmi(contexts(t), "ws", window=2)
    return c.groupBy("word").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("pairs"), F.count_if(F.col("ppmi") > 1e-9).alias("positive"),
                                 F.round(F.max("ppmi"), 6).alias("strongest"))


@query("word_embeddings")
def word_embeddings(t):
    """Nearest words of the most frequent one by the cosine of their vectors."""
    p = checkpointed(TX.ppmi(contexts(t), "ws", window=2))
    vectors = checkpointed(TX.word_vectors(p, dims=16))
    top = p.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").first()
    return TX.nearest_words(vectors, top["word"] if top else "", 10)
