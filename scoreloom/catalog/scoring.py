"""Feature scores, selection and the exact classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.catalog import common as C
from scoreloom.catalog import sql as S
from scoreloom.catalog.registry import query
from scoreloom.functions.hashing import order_key
from scoreloom.operators import bayes, featurize, metrics, neighbors, rank, report, resample, score, split
from scoreloom.session import stored
from scoreloom.sources.tables import labelled_vectors

_CELLS = (
    "cells AS (SELECT t.dataset, t.target, c.idx, c.x FROM train t JOIN doc_cells c ON c.row_id = t.row_id AND t.dataset <> 'events' WHERE c.x <> 0),\n"
    "classes AS (SELECT dataset, target, n::DOUBLE AS n FROM train_counts WHERE dataset <> 'events'),\n"
    "feats AS (SELECT DISTINCT dataset, idx FROM cells),\n"
    "sums AS (SELECT f.dataset, f.idx, k.target, k.n, coalesce(count(c.x), 0)::DOUBLE AS nz, coalesce(sum(c.x), 0) AS s, coalesce(sum(c.x * c.x), 0) AS q, min(c.x) AS lo, max(c.x) AS hi"
    " FROM feats f JOIN classes k ON k.dataset = f.dataset LEFT JOIN cells c ON c.dataset = f.dataset AND c.idx = f.idx AND c.target = k.target GROUP BY ALL)"
)


def _cells(spark, sf):
    rows = C.train_rows(C.labelled(spark, sf, *[f.name for f in C.FAMILIES])).filter(F.col("desc").isNotNull())
    cells = featurize.sparse_cells(rows, C.FAMILIES, ["dataset", "target"]).filter(F.col("x") != 0)
    return cells, resample.class_distribution(rows)


_ANOVA = (
    "anova AS (SELECT dataset, idx, CASE WHEN ssw > 1e-12 THEN ssb / (ssw / (n - 2)) WHEN ssb > 1e-12 THEN 1.7976931348623157e308 ELSE 0.0 END AS score FROM ("
    "SELECT dataset, idx, sum(n) AS n, sum(n * (s / n - m) * (s / n - m)) AS ssb, sum(ss) AS ssw FROM ("
    "SELECT s1.*, sum(s) OVER w / sum(n) OVER w AS m, q - s * s / n AS ss FROM sums s1 WINDOW w AS (PARTITION BY dataset, idx)) GROUP BY dataset, idx))"
)
_CHI2 = (
    "chi AS (SELECT dataset, idx, coalesce(sum(CASE WHEN e <> 0 THEN (s - e) * (s - e) / e END), 0.0) AS score FROM ("
    "SELECT dataset, idx, s, n / sum(n) OVER w * sum(s) OVER w AS e FROM sums WINDOW w AS (PARTITION BY dataset, idx)) GROUP BY dataset, idx)"
)


def _with_cells(extra: str) -> str:
    return S.ctes("train_counts", "doc_cells", extra=_CELLS + (",\n" + extra if extra else ""))


@query("anova_f", _with_cells(_ANOVA) + "SELECT dataset, idx, round(score, 4) AS score FROM anova")
def anova_f(spark, sf):
    cells, classes = _cells(spark, sf)
    return C.rounded(score.anova_f(score.class_moments(cells, classes)), "score", digits=4)


@query("chi2_score", _with_cells(_CHI2) + "SELECT dataset, idx, round(score, 4) AS score FROM chi")
def chi2_score(spark, sf):
    cells, classes = _cells(spark, sf)
    return C.rounded(score.chi2(score.class_moments(cells, classes)), "score", digits=4)


_MI = (
    "rng AS (SELECT c.dataset, c.idx, any_value(t.n) AS n, CASE WHEN count(*) < any_value(t.n) THEN least(min(x), 0.0) ELSE min(x) END AS lo,"
    " CASE WHEN count(*) < any_value(t.n) THEN greatest(max(x), 0.0) ELSE max(x) END AS hi"
    " FROM cells c JOIN (SELECT dataset, sum(n) AS n FROM classes GROUP BY dataset) t ON t.dataset = c.dataset GROUP BY c.dataset, c.idx),\n"
    "seen AS (SELECT c.dataset, c.idx, c.target, least(15, CAST(floor(CASE WHEN hi > lo THEN (x - lo) * 16 / (hi - lo) ELSE 0 END) AS INTEGER)) AS bin, count(*)::DOUBLE AS c"
    " FROM cells c JOIN rng r ON r.dataset = c.dataset AND r.idx = c.idx GROUP BY ALL),\n"
    "absent AS (SELECT s.dataset, s.idx, s.target, least(15, CAST(floor(CASE WHEN r.hi > r.lo THEN (0 - r.lo) * 16 / (r.hi - r.lo) ELSE 0 END) AS INTEGER)) AS bin, s.n - s.nz AS c"
    " FROM sums s JOIN rng r ON r.dataset = s.dataset AND r.idx = s.idx WHERE s.n > s.nz),\n"
    "joint_ AS (SELECT dataset, idx, target, bin, sum(c) AS c FROM (SELECT * FROM seen UNION ALL SELECT * FROM absent) GROUP BY ALL),\n"
    "mi AS (SELECT dataset, idx, greatest(sum(t), 0.0) AS score FROM (SELECT dataset, idx, c / sum(c) OVER f * ln(c * sum(c) OVER f / (sum(c) OVER b * sum(c) OVER k)) AS t FROM joint_"
    " WINDOW f AS (PARTITION BY dataset, idx), b AS (PARTITION BY dataset, idx, bin), k AS (PARTITION BY dataset, idx, target)) GROUP BY dataset, idx)"
)


@query("mutual_info_binned", _with_cells(_MI) + "SELECT dataset, idx, abs(round(score, 6)) AS score FROM mi")
def mutual_info_binned(spark, sf):
    cells, classes = _cells(spark, sf)
    return C.rounded(score.mutual_info_binned(cells, classes), "score").withColumn("score", F.abs("score"))


@query(
    "feature_topk",
    _with_cells(_ANOVA + ",\n" + _CHI2)
    + "SELECT method, dataset, count(*) AS \"K\", method || '_top' || count(*) AS \"SelectionLabel\", string_agg(CAST(idx AS VARCHAR), ',' ORDER BY place) AS features FROM ("
    "SELECT *, row_number() OVER (PARTITION BY method, dataset ORDER BY round(score, 8) DESC, idx) AS place FROM ("
    "SELECT 'ANOVA' AS method, * FROM anova UNION ALL SELECT 'Chi2', * FROM chi)) WHERE place <= 50 GROUP BY method, dataset",
)
def feature_topk(spark, sf):
    cells, classes = _cells(spark, sf)
    moments = stored(score.class_moments(cells, classes), "moments")
    both = (
        score.anova_f(moments).withColumn("method", F.lit("ANOVA"))
        .unionByName(score.chi2(moments).withColumn("method", F.lit("Chi2")))
    )
    best = score.top_k(C.rounded(both, "score", digits=8), ["method", "dataset"], 50)
    return best.select(
        "method", "dataset", "K", F.concat("method", F.lit("_top"), F.col("K").cast("string")).alias("SelectionLabel"),
        F.array_join(F.transform("features", lambda i: i.cast("string")), ",").alias("features"),
    )


# Naive Bayes over key bits and descriptors.
_NB_FEATURES = S.N_KEYS + S.N_DESC


def _nb_sql(lo: int, hi: int, tag: str) -> str:
    """Scores on test rows from features lo..hi-1."""
    return (
        f"g{tag} AS (SELECT s.dataset, s.row_id, s.target, s.split, f.i AS idx, coalesce(c.x, 0.0) AS x"
        f" FROM split s JOIN wide w ON w.row_id = s.row_id AND s.dataset <> 'events' CROSS JOIN (SELECT unnest(range({lo}, {hi})) AS i) f"
        " LEFT JOIN kd_cells c ON c.row_id = s.row_id AND c.idx = f.i),\n"
        f"e{tag} AS (SELECT dataset, max(v) * 1e-9 AS eps FROM (SELECT dataset, idx, var_pop(x) AS v FROM g{tag} WHERE split = 'train' GROUP BY ALL) GROUP BY dataset),\n"
        f"p{tag} AS (SELECT g.dataset, idx, target, count(*)::DOUBLE AS n, avg(x) AS m, var_pop(x) + any_value(eps) AS v FROM g{tag} g JOIN e{tag} e ON e.dataset = g.dataset WHERE split = 'train' GROUP BY ALL),\n"
        f"l{tag} AS (SELECT g.dataset, g.row_id, any_value(g.target) AS target, p.target AS cls, any_value(p.n) AS n,"
        f" sum(-0.5 * (ln(6.283185307179586::DOUBLE * p.v) + (g.x - p.m) * (g.x - p.m) / p.v)) AS ll FROM g{tag} g JOIN p{tag} p ON p.dataset = g.dataset AND p.idx = g.idx"
        " WHERE g.split = 'test' GROUP BY g.dataset, g.row_id, p.target),\n"
        f"nb{tag} AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM (SELECT dataset, row_id, any_value(target) AS target,"
        " 1.0 / (1.0 + exp(greatest(-700.0, least(700.0, max(CASE WHEN cls = 0 THEN ln(n) + ll END) - max(CASE WHEN cls = 1 THEN ln(n) + ll END))))) AS score"
        f" FROM l{tag} GROUP BY dataset, row_id))"
    )


def _nb(rows, names):
    families = C.family(*names)
    dense = featurize.dense_array(rows.filter(F.col("desc").isNotNull()), families).select(
        "dataset", "row_id", "target", "split", "values"
    )
    model = bayes.fit(dense.filter("split = 'train'"))
    return bayes.score(dense.filter("split = 'test'"), model).select("dataset", "row_id", "target", "score", "prediction")


@query(
    "gaussian_nb",
    S.ctes("split", "wide", "kd_cells", extra=_nb_sql(0, _NB_FEATURES, "a"))
    + "SELECT dataset, row_id, target, round(score, 6) AS score, prediction FROM nba",
)
def gaussian_nb(spark, sf):
    rows = split.stratified(C.labelled(spark, sf, "keys", "desc"))
    return C.rounded(_nb(rows, ("keys", "desc")), "score")


@query(
    "gaussian_nb_sparse",
    S.ctes("split", "wide", "doc_cells")
    + """, r AS (SELECT s.* FROM split s JOIN wide w ON w.row_id = s.row_id WHERE s.dataset <> 'events'),
    c AS (SELECT r.*, d.idx, d.x FROM r JOIN doc_cells d ON d.row_id = r.row_id),
    n AS (SELECT dataset, target, count(*)::DOUBLE AS n FROM r WHERE split = 'train' GROUP BY ALL),
    h AS (SELECT dataset, idx, target, count(x)::DOUBLE AS k, avg(x) AS m, var_pop(x) AS v FROM c WHERE split = 'train' GROUP BY ALL),
    f AS (SELECT i.dataset, i.idx, n.target, n.n, coalesce(k, 0) * coalesce(m, 0) / n.n AS mean,
                 (coalesce(k, 0) * coalesce(v, 0) + coalesce(k, 0) * (n.n - coalesce(k, 0)) / n.n * coalesce(m, 0) ** 2) / n.n AS var
          FROM (SELECT DISTINCT dataset, idx FROM h) i JOIN n ON n.dataset = i.dataset
          LEFT JOIN h ON h.dataset = i.dataset AND h.idx = i.idx AND h.target = n.target),
    o AS (SELECT dataset, max(spread) * 1e-9 AS eps FROM (
            SELECT f.dataset, f.idx, sum(f.n * (var + (mean - middle) ** 2)) / sum(f.n) AS spread
            FROM f JOIN (SELECT dataset, idx, sum(n * mean) / sum(n) AS middle FROM f GROUP BY ALL) g ON g.dataset = f.dataset AND g.idx = f.idx
            GROUP BY f.dataset, f.idx) GROUP BY dataset),
    p AS (SELECT f.dataset, f.idx, max(mean) FILTER (target = 0) AS m0, max(mean) FILTER (target = 1) AS m1,
                 max(var + eps) FILTER (target = 0) AS v0, max(var + eps) FILTER (target = 1) AS v1,
                 max(n) FILTER (target = 0) AS n0, max(n) FILTER (target = 1) AS n1
          FROM f JOIN o ON o.dataset = f.dataset GROUP BY f.dataset, f.idx),
    z AS (SELECT dataset, max(ln(n1 / n0)) + sum(0.5 * (ln(v0) - ln(v1) + m0 * m0 / v0 - m1 * m1 / v1)) AS base FROM p GROUP BY dataset),
    g AS (SELECT c.dataset, c.row_id, sum((0.5 / v0 - 0.5 / v1) * x * x + (m1 / v1 - m0 / v0) * x) AS change
          FROM c JOIN p ON p.dataset = c.dataset AND p.idx = c.idx WHERE c.split = 'test' GROUP BY ALL)
    SELECT r.dataset, r.row_id, r.target, round(base + coalesce(change, 0), 1) AS odds, (base + coalesce(change, 0) >= 0)::INTEGER AS prediction
    FROM r JOIN z ON z.dataset = r.dataset LEFT JOIN g ON g.dataset = r.dataset AND g.row_id = r.row_id WHERE r.split = 'test'""",
)
def gaussian_nb_sparse(spark, sf):
    """Log-odds over all four families, from stored cells only."""
    families = [f.name for f in C.FAMILIES]
    rows = split.stratified(C.labelled(spark, sf, *families)).filter(F.col("desc").isNotNull())
    cells = featurize.sparse_cells(rows, C.FAMILIES, ["dataset", "row_id", "target", "split"])
    train = rows.filter("split = 'train'").groupBy("dataset", "target").agg(F.count("*").alias("n"))
    model = bayes.fit_cells(cells.filter("split = 'train'"), train)
    test = rows.filter("split = 'test'").select("dataset", "row_id", "target")
    out = bayes.score_cells(test, cells.filter("split = 'test'").select("dataset", "row_id", "idx", "x"), model)
    return C.rounded(out.drop("score"), "odds", digits=1)


_FAMILY_SQL = (
    S.ctes("split", "wide", "kd_cells", extra=_nb_sql(0, S.N_KEYS, "k") + ",\n" + _nb_sql(S.N_KEYS, _NB_FEATURES, "d"))
    + ", pr AS (SELECT dataset, 'desc' AS experiment, target, round(score, 9) AS score, prediction FROM nbd UNION ALL SELECT dataset, 'keys', target, round(score, 9), prediction FROM nbk),\n"
    + S.ladder("pr", "dataset, experiment") + ",\n" + S.metric_block("m", "ladder", "dataset, experiment")
    + ",\n best AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY ROC DESC, experiment) AS place FROM m)\n"
    + 'SELECT b.dataset AS "Dataset", b.experiment AS "FeatureSet", '
    + ", ".join(f'round(b.{c}, 6) AS "{c}"' for c in ("ROC", "AP", "F1"))
    + ", "
    + ", ".join(
        f'round(o.{c}, 6) AS "Previous_{c}", round(b.{c} - o.{c}, 6) AS "{c}_Delta",'
        f' CASE WHEN abs(o.{c}) > 1e-12 THEN round(100 * (b.{c} - o.{c}) / abs(o.{c}), 6) END AS "{c}_Gain_%"'
        for c in ("ROC", "AP", "F1")
    )
    + " FROM best b JOIN best o ON o.dataset = b.dataset AND b.place = 1 AND o.place = 2"
)


@query("family_comparison", _FAMILY_SQL)
def family_comparison(spark, sf):
    """Naive Bayes per feature family; the better family of each dataset and its gain over the other."""
    rows = split.stratified(C.labelled(spark, sf, "keys", "desc"))
    parts = [
        _nb(rows, (name,)).withColumn("FeatureSet", F.lit(name)) for name in ("desc", "keys")
    ]
    predictions = C.rounded(parts[0].unionByName(parts[1]), "score", digits=9)
    table = metrics.metric_rows(predictions, ["dataset", "FeatureSet"]).withColumnRenamed("dataset", "Dataset")
    best = rank.best_per_group(table, ["Dataset"], "ROC", "FeatureSet")
    rest = table.join(best.select("Dataset", "FeatureSet"), ["Dataset", "FeatureSet"], "left_anti")
    out = report.gain(best, rest, "family", "other family", "FeatureSet")
    numbers = [c for m in report.COMPARED for c in (m, f"Previous_{m}", f"{m}_Delta", f"{m}_Gain_%")]
    return C.rounded(out.select("Dataset", "FeatureSet", *numbers), *numbers)


@query(
    "knn_classify",
    "WITH v AS (SELECT vec_id AS row_id, CAST(label < 3 AS INTEGER) AS target, embedding::DOUBLE[] AS e FROM embeddings),\n"
    "h AS (SELECT *, substr(md5('42:knn:' || row_id), 1, 1) IN ('0', '1', '2') AS asked FROM v),\n"
    "d AS (SELECT q.row_id, t.row_id AS n_id, t.target, list_distance(q.e, t.e) AS dist FROM h q JOIN h t ON q.asked AND NOT t.asked),\n"
    "k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY dist, n_id) AS rn FROM d) WHERE rn <= 7),\n"
    "w AS (SELECT *, CASE WHEN min(dist) OVER (PARTITION BY row_id) = 0 THEN CAST(dist = 0 AS DOUBLE) ELSE 1 / dist END AS wt FROM k)\n"
    "SELECT row_id, round(sum(wt * target) / sum(wt), 6) AS score, CAST(sum(wt * target) / sum(wt) >= 0.5 AS INTEGER) AS prediction FROM w GROUP BY row_id",
)
def knn_classify(spark, sf):
    """All vectors: about a fifth of them asked against the others."""
    rows = labelled_vectors(spark, sf).withColumn(
        "asked", F.substring(order_key(42, "knn", "row_id"), 1, 1).isin("0", "1", "2")
    )
    found = neighbors.knn_classify(rows.filter(~F.col("asked")), rows.filter("asked"), 7)
    return C.rounded(found, "score")
