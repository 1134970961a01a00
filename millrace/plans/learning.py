"""Queries over text features, neighbours, clusterings and Spark ML."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import (
    comparison, curves, density, evaluation, isolation, learn, neighbors, splits, textfeatures, validation,
)
from millrace.operators.ensembles import Forest
from millrace.plans import bindings as b
from millrace.plans.registry import query
from millrace.plans.tabular import _CLEAN, _DIGEST, CLASS_NAMES, r
from millrace.session import cut_lineage, scratch_path

# fixed values: Spark's English stop list (a test holds the two together), as plain text for the SQL side
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some such no nor not only own same so than too
very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're
he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't
didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's
when's where's who's why's would""".split()
_STOP_LIST = "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS) + "]"


def _term_ctes(prefix="", where="true"):
    """Words, their uses with word pairs, and term counts of the documents that meet `where`."""
    return f"""{prefix}words as (
  select doc_id, list_filter(regexp_extract_all({_CLEAN}, '\\w\\w+'), lambda w: not list_contains({_STOP_LIST}, w)) as w
  from documents where {where}),
{prefix}uses as (
  select doc_id, unnest(w) as term from {prefix}words
  union all
  select doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from {prefix}words where len(w) >= 2),
{prefix}terms as (select doc_id, term, count(*) as tf from {prefix}uses group by all)"""


_VOCABULARY = """vocabulary as (
  select term, count(*) as df, sum(tf)::bigint as total from terms group by term having count(*) >= 2
  order by total desc, term limit 5000)"""
_TERMS = f"{_term_ctes()},\n{_VOCABULARY}"


def _documents(spark, d):
    return b.table(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("c"))


@query("top_terms", b.with_ctes(_TERMS) + "select term, df, total from vocabulary")
def top_terms(spark, d):
    return textfeatures.top_terms(textfeatures.term_rows(_documents(spark, d), "doc_id", F.col("c"), STOP_WORDS))


@query("tfidf_weights", b.with_ctes(_TERMS, """raw as (
  select doc_id, term, (1 + ln(tf)) * (ln((1 + (select count(*) from documents)) / (1 + df)) + 1) as w
  from terms join vocabulary using (term))""") + """
select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 9) as weight from raw""")
def tfidf_weights(spark, d):
    return textfeatures.tfidf_weights(_documents(spark, d), "doc_id", F.col("c"), STOP_WORDS).withColumn("weight", r("weight"))


_HELD_OUT = f"cast(('0x' || {_DIGEST.format('doc_id')}) as bigint)::double / 1152921504606846976::double < 0.2"


@query("tfidf_held_out", b.with_ctes(
    _term_ctes("", f"not ({_HELD_OUT})"), _VOCABULARY, _term_ctes("asked_", _HELD_OUT), f"""raw as (
  select doc_id, term, (1 + ln(tf)) * (ln((1 + (select count(*) from documents where not ({_HELD_OUT}))) / (1 + df)) + 1) as w
  from asked_terms join vocabulary using (term))""") + """
select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 9) as weight from raw""")
def tfidf_held_out(spark, d):
    """Weights of held-out documents under a vocabulary learned from the others, saved and loaded again."""
    marked = splits.hash_split(_documents(spark, d), "doc_id", 0.2)
    path = scratch_path(spark, "tfidf")
    textfeatures.TfidfModel.fit(marked.filter(~F.col("is_test")), "doc_id", F.col("c"), STOP_WORDS).save(path)
    loaded = textfeatures.TfidfModel.load(spark, path)
    return loaded.weights(marked.filter("is_test"), "doc_id", F.col("c")).select("doc_id", "term", r("weight").alias("weight"))


_KNN = f"""split as (
  select vec_id, embedding::double[] as v, label, cast(('0x' || {_DIGEST.format('vec_id')}) as bigint)::double / 1152921504606846976::double < 0.2 as is_test
  from embeddings),
pairs as (
  select q.vec_id as query_id, t.vec_id as neighbor_id, t.label,
         sqrt(list_sum(list_transform(list_zip(q.v, t.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) as distance
  from split q, split t where q.is_test and not t.is_test),
nearest as (
  select *, row_number() over (partition by query_id order by distance, neighbor_id) as rank from pairs
  qualify row_number() over (partition by query_id order by distance, neighbor_id) <= 5)"""


def _knn(spark, d):
    marked = splits.hash_split(b.table(spark, d, "embeddings"), "vec_id", 0.2)
    train, test = marked.filter(~F.col("is_test")), marked.filter("is_test")
    return train, neighbors.knn_topk(train, test, 5, "vec_id", "embedding")


@query("knn_topk", b.with_ctes(_KNN) + """
select query_id, neighbor_id, round(distance, 9) as distance, cast(rank as integer) as rank from nearest""")
def knn_topk(spark, d):
    return _knn(spark, d)[1].withColumn("distance", r("distance"))


@query("knn_vote", b.with_ctes(_KNN) + """
select query_id, label as prediction, count(*) as votes from nearest group by query_id, label
qualify row_number() over (partition by query_id order by count(*) desc, label) = 1""")
def knn_vote(spark, d):
    train, nearest = _knn(spark, d)
    return neighbors.knn_vote(nearest, train, "vec_id", "label")


def _plane(spark, d):
    """Two embedding coordinates as points of a plane, stretched to a spread near 1."""
    return b.table(spark, d, "embeddings").select(
        "vec_id", (F.col("embedding")[0].cast("double") * 8).alias("x"), (F.col("embedding")[1].cast("double") * 8).alias("y"))


_PLANE = """plane as (select vec_id, embedding[1]::double * 8 as x, embedding[2]::double * 8 as y from embeddings),
near as (select a.vec_id as u, b.vec_id as v from plane a join plane b on sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= {eps}),
core as (select u as vec_id, count(*) >= 5 as is_core from near group by u)"""


@query("dbscan_core", b.with_ctes(_PLANE.format(eps=0.2)) + "select vec_id, is_core from core")
def dbscan_core(spark, d):
    return density.core_flags(_plane(spark, d), "vec_id", ["x", "y"], 0.2, 5)


@query("dbscan_clusters", b.with_ctes(_PLANE.format(eps=0.2)).replace("with ", "with recursive ", 1) + """,
links as (select u, v from near join core cu on u = cu.vec_id join core cv on v = cv.vec_id where cu.is_core and cv.is_core),
reach(u, v) as (select u, v from links union select r.u, l.v from reach r join links l on r.v = l.u),
rooted as (select u as vec_id, min(v) as root from reach group by u),
assigned as (select vec_id, root from rooted
  union all
  select n.u, min(root) from near n join core c on n.u = c.vec_id join rooted r on n.v = r.vec_id where not c.is_core group by n.u)
select count(distinct root) as n_clusters, (select count(*) from plane) - count(*) as n_noise from assigned""")
def dbscan_clusters(spark, d):
    return density.cluster_counts(density.dbscan(_plane(spark, d), "vec_id", ["x", "y"], 0.2, 5))


# --- Spark ML: values depend on its solvers and random draws, so these have no SQL ---


@query("standardize", " union all ".join(
    f"""select '{c}' as feature, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 6) as scaled from lineitem""" for c in b.DRIFT_COLUMNS))
def standardize(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    scaled = learn.standardize(b.table(spark, d, "lineitem"), b.DRIFT_COLUMNS)
    long = scaled.select(*keys, *[F.col(f"{c}_scaled").alias(c) for c in b.DRIFT_COLUMNS]).unpivot(
        keys, b.DRIFT_COLUMNS, "feature", "scaled")
    return long.withColumn("scaled", r("scaled", 6))


@query("pca_variance")
def pca_variance(spark, d):
    model = learn.fit_pca(b.profiles(spark, d), b.PROFILE_COLUMNS, len(b.PROFILE_COLUMNS))
    return learn.explained_variance(model, spark)


@query("forest_predictions")
def forest_predictions(spark, d):
    marked = splits.hash_split(b.profiles(spark, d), "id", 0.2)
    stages = learn.preparation(b.PROFILE_COLUMNS) + [learn.random_forest(100, 5)]
    model = Pipeline(stages=stages).fit(marked.filter(~F.col("is_test")))
    return model.transform(marked.filter("is_test")).select("id", "label", "prediction")


@query("classifier_benchmark")
def classifier_benchmark(spark, d):
    return comparison.classifier_benchmark(b.profiles(spark, d), "id", b.PROFILE_COLUMNS, "label")


@query("grid_results")
def grid_results(spark, d):
    return comparison.search(b.profiles(spark, d), "id", b.PROFILE_COLUMNS, "label",
                             comparison.forest_grid([50, 100, 200], [3, 5, 10], [1, 5]))


@query("param_search")
def param_search(spark, d):
    return comparison.search(b.profiles(spark, d), "id", b.PROFILE_COLUMNS, "label", comparison.sampled_forests(20))


@query("cv_scores")
def cv_scores(spark, d):
    strategies = {"5-fold": (5, 7, False), "10-fold": (10, 7, False), "stratified 5-fold": (5, 42, True)}
    return comparison.cv_scores(b.profiles(spark, d), "id", b.PROFILE_COLUMNS, "label", Forest(100, 5), strategies)


@query("learning_curve")
def learning_curve(spark, d):
    models = {f"depth {depth}": Forest(100, depth) for depth in (1, 5, 10)}
    return comparison.learning_curve(b.profiles(spark, d), "id", b.PROFILE_COLUMNS, "label", models)


@query("calibrated_scores")
def calibrated_scores(spark, d):
    rows = b.profiles(spark, d).withColumn("label", (F.col("label") == 2).cast("double"))
    marked = cut_lineage(splits.exact_split(rows.select("id", "label", *b.PROFILE_COLUMNS), "id", 0.3), "calibration")
    train, test = marked.filter(~F.col("is_test")), marked.filter("is_test").drop("is_test")
    forest = learn.with_preparation(b.PROFILE_COLUMNS, learn.random_forest(100, 5))
    scored = learn.calibrated_by(train.drop("is_test"), test, "id", forest,
                                 {"platt": learn.PlattScaling(), "isotonic": learn.IsotonicScaling()}, 5)
    long = scored.select(F.col("label").alias("y"), "platt", "isotonic").unpivot("y", ["platt", "isotonic"], "method", "score")
    return curves.calibration_curve(long, 10, keys=["method"])


@query("regression_models")
def regression_models(spark, d):
    rows = b.profiles(spark, d).drop("label").withColumnRenamed("target", "label")
    marked = splits.exact_split(rows.select("id", "label", *b.PROFILE_COLUMNS), "id", 0.2)
    train = marked.filter(~F.col("is_test"))
    scaler = Pipeline(stages=learn.preparation(b.PROFILE_COLUMNS, True)).fit(train)
    shaped = cut_lineage(scaler.transform(marked).select("label", "features", "is_test"), "regression")
    return learn.regression_models(shaped.filter(~F.col("is_test")), shaped.filter("is_test"), boosting_rounds=100)


def _scaled_profiles(spark, d):
    rows = b.profiles(spark, d)
    scaled = Pipeline(stages=learn.preparation(b.PROFILE_COLUMNS, True)).fit(rows).transform(rows)
    return cut_lineage(scaled.select("id", "label", "features"), "profiles")


@query("kmeans_elbow")
def kmeans_elbow(spark, d):
    return learn.kmeans_elbow(_scaled_profiles(spark, d), restarts=10)


@query("kmeans_agreement")
def kmeans_agreement(spark, d):
    rows = _scaled_profiles(spark, d)
    labelled = learn.best_kmeans(rows, 3, 10).transform(rows)
    return evaluation.adjusted_rand(labelled, "label", "prediction")


@query("feature_importance")
def feature_importance(spark, d):
    rows = b.profiles(spark, d).withColumn("label", F.col("label").cast("double"))
    model = learn.with_preparation(b.PROFILE_COLUMNS, learn.random_forest(100, 5)).fit(rows)
    return learn.feature_importance(model.stages[-1], b.PROFILE_COLUMNS, spark)


@query("anomaly_scores")
def anomaly_scores(spark, d):
    rows = b.profiles(spark, d).select("id", *b.PROFILE_COLUMNS)
    return isolation.flag_anomalies(isolation.anomaly_scores(rows, "id", b.PROFILE_COLUMNS, trees=100), 0.06)


LANGUAGES = {0: "de", 1: "en", 2: "es", 3: "fr"}


@query("text_classifier")
def text_classifier(spark, d):
    """Language of a document from its words, all learned on the training documents: report on the others."""
    code = F.coalesce(*[F.when(F.col("lang") == n, F.lit(float(i))) for i, n in LANGUAGES.items()])
    docs = b.table(spark, d, "documents").select(
        "doc_id", code.alias("label"), text.clean_text(F.col("text")).alias("c"))
    kept = docs.filter(text.word_count(F.col("c")) >= 3)
    marked = cut_lineage(splits.stratified_split(kept, "doc_id", "label"), "texts")
    train, test = marked.filter(~F.col("is_test")), marked.filter("is_test")
    terms = textfeatures.TfidfModel.fit(train, "doc_id", F.col("c"), textfeatures.english_stop_words())
    model = learn.text_classifier(terms.vectors(train, "doc_id", F.col("c"), ["label"]), max_iter=1000)
    scored = model.transform(terms.vectors(test, "doc_id", F.col("c"), ["label"]))
    return evaluation.classification_report(scored, "label", "prediction")


@query("batch_score")
def batch_score(spark, d):
    rows = b.profiles(spark, d)
    model = Pipeline(stages=learn.preparation(b.PROFILE_COLUMNS) + [learn.random_forest()]).fit(rows)
    scored = learn.batch_score(model, rows, CLASS_NAMES, ["id"])
    return scored.select("id", "prediction", "class_name", "confidence", F.map_entries("probabilities").alias("probabilities"))


@query("train_and_gate")
def train_and_gate(spark, d):
    v = validation
    checks = [v.no_nulls("label"), v.all_positive("n_orders"), v.only_values("label", [0, 1, 2]), v.not_empty()]
    done = learn.train_and_gate(b.profiles(spark, d), "id", b.PROFILE_COLUMNS, "label", checks, 150, 6, 0.90)
    return done.verdict
