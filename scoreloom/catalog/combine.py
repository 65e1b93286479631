"""Score combination checked on deterministic scores: every descriptor is a view."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.catalog import common as C
from scoreloom.catalog import sql as S
from scoreloom.catalog.registry import query
from scoreloom.operators import ensemble, split

# Views of the equal-weight combination and weights of the vote.
VIEWS = (3, 5, 7, 8, 10, 11, 13)
WEIGHTS = {5: 2.0, 7: 1.0, 10: 1.0, 13: 1.0}


def _test(spark, sf):
    return C.with_prediction(C.univariate_scores(spark, sf).filter("split = 'test'").withColumnRenamed("view", "FeatureSet"))


@query(
    "soft_voting",
    S.ctes("scored")
    + "SELECT dataset, row_id, target, round(s, 6) AS score, CAST(s >= 0.5 AS INTEGER) AS prediction FROM ("
    "SELECT dataset, row_id, any_value(target) AS target, sum(w * score) / sum(w) AS s FROM scored JOIN (VALUES "
    + ", ".join(f"({v}, {w}::DOUBLE)" for v, w in WEIGHTS.items())
    + ") v(view, w) USING (view) WHERE split = 'test' GROUP BY dataset, row_id)",
)
def soft_voting(spark, sf):
    rows = _test(spark, sf).withColumn("member", F.col("FeatureSet").cast("string"))
    return C.rounded(ensemble.soft_vote(rows, "member", {str(v): w for v, w in WEIGHTS.items()}), "score")


@query(
    "multiview_equal",
    S.ctes("scored")
    + "SELECT dataset, row_id, target, round(s, 6) AS score, CAST(s >= 0.5 AS INTEGER) AS prediction FROM ("
    f"SELECT dataset, row_id, any_value(target) AS target, avg(score) AS s FROM scored WHERE split = 'test' AND view IN {VIEWS} GROUP BY dataset, row_id)",
)
def multiview_equal(spark, sf):
    return C.rounded(ensemble.multiview_equal(_test(spark, sf), VIEWS), "score")


_VALID = (
    "valid AS (SELECT s.dataset, s.view, s.target, s.score, CAST(s.score >= 0.5 AS INTEGER) AS prediction FROM scored s"
    " JOIN inner_split i ON i.dataset = s.dataset AND i.row_id = s.row_id AND i.\"inner\" = 'valid'),\n"
    + S.ladder("valid", "dataset, view")
    + ",\n"
    + S.metric_block("m", "ladder", "dataset, view")
)


def _both(spark, sf):
    """(validation, test) predictions of every view."""
    rows = C.with_prediction(C.univariate_scores(spark, sf).withColumnRenamed("view", "FeatureSet"))
    inner = split.nested(C.train_pool(spark, sf)).filter("inner = 'valid'").select("dataset", "row_id")
    return rows.join(inner, ["dataset", "row_id"], "left_semi"), rows.filter("split = 'test'")


@query(
    "view_validation",
    S.ctes("scored", "inner_split", extra=_VALID)
    + 'SELECT dataset, CAST(view AS INTEGER) AS "FeatureSet", round(ROC, 6) AS "InnerValidationROC", round(AP, 6) AS "InnerValidationAP", round(F1, 6) AS "InnerValidationF1" FROM m',
)
def view_validation(spark, sf):
    table = ensemble.view_validation(_both(spark, sf)[0])
    return C.rounded(table, "InnerValidationROC", "InnerValidationAP", "InnerValidationF1")


@query(
    "top4_view_ensemble",
    S.ctes("scored", "inner_split", extra=_VALID)
    + ", best AS (SELECT dataset, view FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY ROC DESC, view) AS place FROM m) WHERE place <= 4)\n"
    "SELECT dataset, row_id, target, round(s, 6) AS score, CAST(s >= 0.5 AS INTEGER) AS prediction FROM ("
    "SELECT s.dataset, row_id, any_value(target) AS target, avg(score) AS s FROM scored s JOIN best b ON b.dataset = s.dataset AND b.view = s.view WHERE split = 'test' GROUP BY s.dataset, row_id)",
)
def top4_view_ensemble(spark, sf):
    valid, test = _both(spark, sf)
    return C.rounded(ensemble.top_k_views(valid, test), "score")
