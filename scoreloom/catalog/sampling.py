"""Ranks, splits, folds, resampling and weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.catalog import common as C
from scoreloom.catalog import sql as S
from scoreloom.catalog.registry import query
from scoreloom.functions.hashing import order_key
from scoreloom.operators import rank, resample, search, split
from scoreloom.sources.tables import table


@query(
    "distributed_rank",
    "SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('42:rank:' || o_orderkey), o_orderkey) AS \"rank\" FROM orders",
)
def distributed_rank(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", order_key(42, "rank", "o_orderkey").alias("key"))
    return rank.exact_rank(rows, ["o_orderstatus"], "key", "o_orderkey").drop("key")


@query("stratified_split", S.ctes("split") + "SELECT dataset, row_id, target, split FROM split")
def stratified_split(spark, sf):
    return split.stratified(C.pool(spark, sf)).select("dataset", "row_id", "target", "split")


@query("nested_split", S.ctes("inner_split") + 'SELECT dataset, row_id, target, "inner" FROM inner_split')
def nested_split(spark, sf):
    return split.nested(C.train_pool(spark, sf)).select("dataset", "row_id", "target", "inner")


@query(
    "stratified_kfold",
    S.ctes("train")
    + "SELECT dataset, row_id, target, CAST(ntile(3) OVER (PARTITION BY dataset, target ORDER BY md5('42:fold:' || row_id), row_id) - 1 AS INTEGER) AS fold FROM train",
)
def stratified_kfold(spark, sf):
    return split.kfold(C.train_pool(spark, sf)).select("dataset", "row_id", "target", "fold")


_OVER = (
    "plan AS (SELECT c.dataset, c.target, c.n, CASE WHEN pos / neg < r AND c.target = 1 THEN CAST(ceil(r * neg) AS BIGINT)"
    " WHEN pos / neg >= r AND c.target = 0 THEN CAST(ceil(pos / r) AS BIGINT) ELSE c.n END AS wanted"
    " FROM train_counts c JOIN balance b ON b.dataset = c.dataset, (SELECT 1.0::DOUBLE AS r)),\n"
    "ranked AS (SELECT dataset, target, row_id, row_number() OVER (PARTITION BY dataset, target ORDER BY md5('42:over:' || row_id), row_id) AS rk FROM train),\n"
    "draws AS (SELECT dataset, target, " + S.slot("'42:over:' || target || ':' || s", "n") + " + 1 AS rk, count(*) AS copies"
    " FROM (SELECT dataset, target, n, unnest(range(wanted)) AS s FROM plan WHERE wanted > n) GROUP BY ALL)\n"
)


@query(
    "resample_over",
    S.ctes("train_counts", "balance", extra=_OVER.rstrip("\n"))
    + "\nSELECT r.dataset, r.target, r.row_id, CAST(d.copies AS BIGINT) AS copies, CAST(d.copies * (d.copies + 1) / 2 AS BIGINT) AS copy_sum FROM ranked r JOIN draws d USING (dataset, target, rk)"
    " UNION ALL SELECT t.dataset, t.target, t.row_id, 1, 1 FROM train t JOIN plan p ON p.dataset = t.dataset AND p.target = t.target AND p.wanted <= p.n",
)
def resample_over(spark, sf):
    rows = resample.to_ratio(C.train_pool(spark, sf), 1.0, "oversampling")
    return rows.groupBy("dataset", "target", "row_id").agg(
        F.count(F.lit(1)).alias("copies"), F.sum("copy_no").alias("copy_sum")
    )


@query(
    "resample_under",
    S.ctes("train_counts", "balance")
    + "SELECT dataset, target, row_id FROM (SELECT t.*, row_number() OVER (PARTITION BY t.dataset, t.target ORDER BY md5('42:under:' || row_id), row_id) AS rk,"
    " CASE WHEN pos / neg < r AND target = 0 THEN least(neg, greatest(5, floor(pos / r)))"
    " WHEN pos / neg >= r AND target = 1 THEN least(pos, greatest(5, floor(r * neg)))"
    " WHEN target = 1 THEN pos ELSE neg END AS wanted"
    " FROM train t JOIN balance b ON b.dataset = t.dataset, (SELECT 0.2::DOUBLE AS r)) WHERE rk <= wanted",
)
def resample_under(spark, sf):
    rows = resample.to_ratio(C.train_pool(spark, sf), 0.2, "undersampling")
    return rows.select("dataset", "target", "row_id")


@query(
    "resample_scenarios",
    S.ctes("balance")
    + ", s AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{n}', '{m}', {r}::DOUBLE)" for n, r, m in resample.SCENARIOS)
    + ') v("SamplingScenario", "SamplingMethod", "SamplingRatio"))\n'
    'SELECT dataset, "SamplingScenario", "SamplingMethod", "SamplingRatio",'
    " CAST(CASE WHEN \"SamplingMethod\" = 'oversampling' AND pos / neg >= r THEN ceil(pos / r)"
    " WHEN \"SamplingMethod\" = 'undersampling' AND pos / neg < r THEN least(neg, greatest(5, floor(pos / r))) ELSE neg END AS BIGINT) AS \"TrainClass0_after_sampling\","
    " CAST(CASE WHEN \"SamplingMethod\" = 'oversampling' AND pos / neg < r THEN ceil(r * neg)"
    " WHEN \"SamplingMethod\" = 'undersampling' AND pos / neg >= r THEN least(pos, greatest(5, floor(r * neg))) ELSE pos END AS BIGINT) AS \"TrainClass1_after_sampling\""
    ' FROM (SELECT b.*, s.*, "SamplingRatio" AS r FROM balance b, s)',
)
def resample_scenarios(spark, sf):
    return resample.scenario_counts(C.train_pool(spark, sf))


@query(
    "class_weights",
    S.ctes("pool")
    + "SELECT dataset, target, n AS rows, round(total / (classes * n), 6) AS weight FROM ("
    "SELECT dataset, target, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY dataset) AS DOUBLE) AS total,"
    " count(*) OVER (PARTITION BY dataset) AS classes FROM pool GROUP BY dataset, target)",
)
def class_weights(spark, sf):
    return C.rounded(resample.class_weights(resample.class_distribution(C.pool(spark, sf))), "weight")


@query("class_distribution", S.ctes("pool") + "SELECT dataset, target, count(*) AS rows FROM pool GROUP BY dataset, target")
def class_distribution(spark, sf):
    return resample.class_distribution(C.pool(spark, sf)).orderBy("dataset", "target")


_SPACE = list(search.FOREST_SPACE.items())


def _space_sql() -> str:
    parts, step = [], 1
    for name, values in reversed(_SPACE):
        texts = ", ".join("'" + ("None" if v is None else str(v)) + "'" for v in values)
        parts.append(f"([{texts}])[(combo // {step}) % {len(values)} + 1] AS {name}")
        step *= len(values)
    return ", ".join(reversed(parts))


@query(
    "param_sample",
    "WITH d AS (SELECT source AS dataset, count(*) AS rows FROM documents GROUP BY source),\n"
    "g AS (SELECT dataset, rows, unnest(range(3600)) AS combo FROM d),\n"
    "k AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY md5('42:params:' || dataset || ':' || combo), combo) AS rn FROM g)\n"
    f"SELECT dataset, rows, combo, {_space_sql()} FROM k WHERE rn <= 10",
)
def param_sample(spark, sf):
    """Ten forest settings for each document source, drawn without replacement."""
    sources = table(spark, sf, "documents").groupBy(F.col("source").alias("dataset")).agg(F.count(F.lit(1)).alias("rows"))
    return search.sample_params_by(sources, "dataset", 10)
