"""Classifier queries on documents (text) with tags ``<lang><source>``."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumlens import constants as K
from forumlens.functions.hashing import md5_int
from forumlens.functions.tags import tag_array
from forumlens.operators import classify as C
from forumlens.operators import metrics as M
from forumlens.operators import text as X
from forumlens.operators.joint import score_posts
from forumlens.plans import sql
from forumlens.plans.registry import query
from forumlens.plans.text import _CLEAN_DOC, _sql_words
from forumlens.session import materialize, shared_path
from forumlens.sources import fixtures as fx
from forumlens.sources import formats as fmt
from forumlens.sources.sinks import ModelStore

V = X.NUM_FEATURES


def _lines(spark, sf):
    """embeddings rendered as multi-label text lines ``l1,l2#f1 f2 ... f64``
    over the whole vector (integer features floor(x * 1000): float text
    differs between engines)."""
    e = fx.read_table(spark, sf, "embeddings")
    feats = F.array_join(F.transform("embedding", lambda x: F.floor(
        x.cast("double") * 1000).cast("string")), " ")
    line = F.concat(F.col("label").cast("string"), F.lit(","),
                    (F.col("label") % 2).cast("string"), F.lit("#"), feats)
    return e.select("vec_id", line.alias("value"))


def _parsed(spark, sf):
    return C.explode_labels(fmt.parse_multilabel_lines(_lines(spark, sf)))


_NB_ROWS = """SELECT vec_id, CAST(l AS DOUBLE) AS label, CAST(p - 1 AS INTEGER) AS pos,
       CAST(floor(CAST(embedding[p] AS DOUBLE) * 1000) AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, unnest([label, label % 2]) AS l FROM embeddings),
     LATERAL (SELECT unnest(generate_series(1, len(embedding))) AS p)"""


@query("nb_parse", _NB_ROWS)
def nb_parse(spark, sf):
    p = _parsed(spark, sf)
    return p.select("vec_id", "label", F.posexplode("features").alias("pos", "value"))


@query("nb_label_stats", f"""SELECT label, pos, count(*) AS n, sum(value) AS total
FROM ({_NB_ROWS}) GROUP BY label, pos""")
def nb_label_stats(spark, sf):
    return C.label_feature_sums_long(_parsed(spark, sf))


@query("nb_file", f"""SELECT label, pos, count(*) AS n, sum(value) AS total
FROM ({_NB_ROWS}) GROUP BY label, pos""")
def nb_file(spark, sf):
    """The multi-label lines written as text in the shared folder, read
    back and summed per label."""
    path = shared_path(spark, "multilabel")
    _lines(spark, sf).select("value").write.text(path)
    return C.label_feature_sums_long(C.explode_labels(fmt.read_multilabel_vectors(spark, path)))


_DOC_TF = f"""tf AS (SELECT Id, {sql.md5_bucket('w', V)} AS bucket, count(*) AS tf
  FROM (SELECT doc_id AS Id, unnest({_sql_words(_CLEAN_DOC)}) AS w FROM documents)
  GROUP BY ALL),
dl AS (SELECT doc_id AS Id, unnest({sql.tag_array("'<' || lang || '><' || source || '>'")})
       AS label FROM documents)"""


def _doc_tf(spark, sf):
    d = fx.document_posts(spark, sf)
    tf = X.text_features(X.clean_text(d.select("Id", "Text"), None, "Text"), "Id", "Text")
    labels = d.select("Id", F.explode(tag_array("Tags")).alias("label"))
    return tf, labels


@query("nb_train", f"""WITH {_DOC_TF},
s AS (SELECT label, bucket, sum(tf) AS t_cj FROM tf JOIN dl USING (Id) GROUP BY ALL),
tt AS (SELECT label, sum(t_cj) AS t_c FROM s GROUP BY label),
nd AS (SELECT label, count(*) AS n_docs FROM dl GROUP BY label),
g AS (SELECT sum(n_docs) AS n, count(*) AS L FROM nd)
SELECT s.label, s.bucket, round(ln((t_cj + 1) / (t_c + {V})), 10) AS theta,
       round(ln((n_docs + 1) / (n + L)), 10) AS pi,
       round(ln(1 / (t_c + {V})), 10) AS theta_default
FROM s JOIN tt USING (label) JOIN nd USING (label), g""")
def nb_train(spark, sf):
    d = fx.document_posts(spark, sf)
    words = X.remove_stop_words(X.tokenize(X.clean_text(d, None, "Text"), "Text"))
    docs = words.select("Id", "words", tag_array("Tags").alias("labels"))
    theta, priors = C.nb_fit_docs(docs, "words", "labels", V)
    return theta.join(priors, "label").select(
        "label", "bucket", F.round("theta", 10).alias("theta"),
        F.round("pi", 10).alias("pi"),
        F.round("theta_default", 10).alias("theta_default"))


def _doc_arrays(spark, sf):
    """(Id, Tags, buckets, tf) of every document, staged."""
    d = fx.document_posts(spark, sf)
    words = X.remove_stop_words(X.tokenize(X.clean_text(d, None, "Text"), "Text"))
    return materialize(X.hashed_tf_arrays(words.select("Id", "Tags", "words"), "words", V), "arrays")


def _formula_weights(docs):
    """A fixed-formula linear model per tag over the buckets seen with it:
    w = (md5(tag:bucket) mod 2001 - 1000) / 1000, b = (md5(tag) mod 200 - 150) / 100."""
    labels = docs.select(F.explode(tag_array("Tags")).alias("tag"), "buckets")
    seen = labels.select("tag", F.explode("buckets").alias("bucket")).distinct()
    w = seen.select("tag", "bucket", ((md5_int(F.concat(
        F.col("tag"), F.lit(":"), F.col("bucket").cast("string"))) % 2001 - 1000)
        / F.lit(1000.0)).alias("w"))
    b = labels.select("tag").distinct().select(
        "tag", ((md5_int("tag") % 200 - 150) / F.lit(100.0)).alias("b"))
    return w, b


_SCORE_SQL = f"""WITH {_DOC_TF},
seen AS (SELECT DISTINCT label AS tag, bucket FROM tf JOIN dl USING (Id)),
w AS (SELECT tag, bucket, ({sql.md5_int("tag || ':' || CAST(bucket AS VARCHAR)")} % 2001 - 1000)
      / 1000.0 AS w FROM seen),
b AS (SELECT tag, ({sql.md5_int('tag')} % 200 - 150) / 100.0 AS b
      FROM (SELECT DISTINCT label AS tag FROM dl)),
dots AS (SELECT Id, tag, sum(tf * w) AS dot FROM tf JOIN w USING (bucket) GROUP BY ALL
         UNION ALL
         SELECT Id, tag, 0.0 FROM (SELECT DISTINCT doc_id AS Id FROM documents), (SELECT tag FROM b WHERE b > 0)),
m AS (SELECT Id, tag, sum(dot) + any_value(b) AS margin FROM dots JOIN b USING (tag) GROUP BY Id, tag)
SELECT Id, tag, round(margin, 6) AS margin FROM m WHERE round(margin, 6) > 0"""


@query("score_linear_models", _SCORE_SQL)
def score_linear_models(spark, sf):
    # the arrays feed the weights and the scores: compute them once
    docs = _doc_arrays(spark, sf)
    out = score_posts(docs, *_formula_weights(docs))
    out = out.select("Id", "tag", F.round("margin", 6).alias("margin"))
    return out.where(F.col("margin") > 0)


@query("predicted_tag_strings", f"""SELECT Id, string_agg(tag, ' ' ORDER BY tag) AS tags
FROM ({_SCORE_SQL}) GROUP BY Id""")
def predicted_tag_strings(spark, sf):
    """F13 over the one-pass scores: each document's positive tags as text."""
    return C.predicted_tag_list(score_linear_models(spark, sf))


# ---- trained models (rows-only checks) --------------------------------------

def _docs(spark, sf):
    d = fx.document_posts(spark, sf)
    return X.clean_text(d, None, "Text", out="Clean").select(
        "Id", "Tags", F.col("Clean").alias("Text"))


@query("train_one_tag")
def train_one_tag(spark, sf):
    """M2: LR by L-BFGS (no intercept, no regularisation), 70/30 hash split,
    predictions on the held-out 30% with raw margins."""
    _, pred = C.train_one_tag(_docs(spark, sf), "en", kind="lr_lbfgs")
    return pred


@query("one_tag_metrics")
def one_tag_metrics(spark, sf):
    """A8-A11 as the hold-out program reports them: confusion counts,
    accuracy (also printed as precision and recall), and AUC on the hard 0/1
    predictions of the L-BFGS model."""
    _, pred = C.train_one_tag(_docs(spark, sf), "en", kind="lr_lbfgs", score="hard")
    pred = materialize(pred, "one-tag-pred")
    auc = M.auc_roc(pred).first()[0]
    return M.binary_metrics(pred).select("tp", "fp", "fn", "tn", "accuracy",
                                         "precision", "recall",
                                         F.lit(auc).alias("auc_roc"))


@query("train_sampled_tag")
def train_sampled_tag(spark, sf):
    """M1 + X5 + R1: hashing (64 000) + LR(30, 0.02) pipeline on a 0.9
    per-class sample, substring label, evaluated on its own training rows."""
    f = K.CLASS_SAMPLE_FRACTION
    _, pred = C.train_one_tag(_docs(spark, sf), "src1", match="substring",
                              kind="lr", num_features=K.PIPELINE_NUM_FEATURES,
                              sample={0.0: f, 1.0: f}, evaluate_on="train")
    return pred


@query("train_svm")
def train_svm(spark, sf):
    """M5: linear SVM (30 iterations, L2 0.01, no intercept), raw margins."""
    _, pred = C.train_one_tag(_docs(spark, sf), "de", kind="svm")
    return pred


@query("svm_metrics")
def svm_metrics(spark, sf):
    """A11 + A12 on the SVM's held-out margins, plus accuracy."""
    _, pred = C.train_one_tag(_docs(spark, sf), "de", kind="svm")
    pred = materialize(pred, "svm-pred")
    areas = M.curve_areas(pred).first()
    return M.binary_metrics(pred).select(
        "accuracy", F.lit(areas["auc_roc"]).alias("auc_roc"), F.lit(areas["auc_pr"]).alias("auc_pr"))


_SAMPLED = {0.0: K.CLASS_SAMPLE_FRACTION, 1.0: K.CLASS_SAMPLE_FRACTION}
# (kind, tag, how it is labelled and trained): the programs' three estimators
CERTIFIED = [("lr_lbfgs", "en", {}), ("svm", "de", {}),
             ("lr", "src1", {"match": "substring", "sample": _SAMPLED, "num_features": K.PIPELINE_NUM_FEATURES})]


@query("model_certificates", " UNION ALL ".join(f"""
SELECT '{kind}' AS model, '{tag}' AS tag, count(*) AS n, count_if({label}) AS n_pos, TRUE AS near_optimal, TRUE AS loss_fell
FROM documents WHERE {sql.md5_unit('doc_id')} < {part}""" for kind, tag, label, part in (
    ("lr_lbfgs", "en", "lang = 'en' OR source = 'en'", K.HOLDOUT_WEIGHTS[0]),
    ("svm", "de", "lang = 'de' OR source = 'de'", K.HOLDOUT_WEIGHTS[0]),
    ("lr", "src1", "contains('<' || lang || '><' || source || '>', 'src1')", K.CLASS_SAMPLE_FRACTION))))
def model_certificates(spark, sf):
    """M1, M2, M5 with X4-X6: each estimator's training rows counted, and its
    gradient at the fitted coefficients against the one at 0."""
    docs = materialize(_docs(spark, sf), "clean-docs")
    rows = []
    for kind, tag, how in CERTIFIED:
        model, _ = C.train_one_tag(docs, tag, kind=kind, **how)
        train, _ = C.training_rows(docs, tag, **{k: v for k, v in how.items() if k != "num_features"})
        c = C.certificate(model, train, kind)
        rows.append((kind, tag, c["n"], c["n_pos"], c["near_optimal"], c["loss"] < c["start_loss"]))
    return spark.createDataFrame(rows, "model string, tag string, n long, n_pos long, near_optimal boolean, loss_fell boolean")


def _vocabulary(docs):
    return docs.select(F.explode(tag_array("Tags")).alias("TagName")).distinct()


@query("train_all_tags", f"""SELECT tag, count(*) AS n_pos, (SELECT count(*) FROM documents) AS n, TRUE AS converged
FROM (SELECT doc_id, unnest(list_distinct({sql.tag_array("'<' || lang || '><' || source || '>'")})) AS tag FROM documents)
GROUP BY tag""")
def train_all_tags(spark, sf):
    """M3 + S13 + S14: one model per tag, fitted together, committed to a
    model store as one version and read back from it."""
    docs = _doc_arrays(spark, sf)
    _, manifest = C.train_all_tags(docs, _vocabulary(docs), store=ModelStore(shared_path(spark, "tag-models")))
    return manifest.select("tag", "n_pos", "n", "converged")


@query("model_store_weights", f"""WITH {_DOC_TF}
SELECT tag, bucket, ({sql.md5_int("tag || ':' || CAST(bucket AS VARCHAR)")} % 2001 - 1000) / 1000.0 AS w,
       ({sql.md5_int('tag')} % 200 - 150) / 100.0 AS b
FROM (SELECT DISTINCT label AS tag, bucket FROM tf JOIN dl USING (Id))""")
def model_store_weights(spark, sf):
    """S13 + S14: fixed-formula models written to a store as one version, and
    its weights and intercepts read back through the store."""
    w, b = _formula_weights(_doc_arrays(spark, sf))
    store = ModelStore(shared_path(spark, "tag-models"))
    store.write_weights(w, b, b.select("tag"))
    w, b = store.weights(spark, store.latest(spark))
    return w.join(b, "tag")


@query("predicted_tags")
def predicted_tags(spark, sf):
    """M4 + S14 with trained models: the models are committed to a store,
    their weights read back by one distributed scan of it, and every model is
    scored over every document in one job."""
    docs = _doc_arrays(spark, sf)
    store = ModelStore(shared_path(spark, "tag-models"))
    C.train_all_tags(docs, _vocabulary(docs), store=store)
    return score_posts(docs, *store.weights(spark))
