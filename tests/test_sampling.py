"""Exact counts, determinism and leakage rules of splits, folds and resampling."""

import pytest
from pyspark.sql import functions as F

from scoreloom.functions.hashing import order_key
from scoreloom.operators import rank, resample, split

# Known class counts (negatives, positives) and their held-out shares.
FIRST, SECOND = (746, 238), (577, 1137)


def rows(spark, neg, pos, dataset="d"):
    return spark.range(neg + pos).select(
        F.lit(dataset).alias("dataset"), F.col("id").alias("row_id"), (F.col("id") >= neg).cast("int").alias("target")
    )


def counts(df, *keys):
    return {tuple(r[k] for k in keys): r["count"] for r in df.groupBy(*keys).count().collect()}


@pytest.mark.parametrize("sizes,test,valid", [(FIRST, (149, 48), (149, 48)), (SECOND, (115, 228), (116, 227))])
def test_holdout_and_inner_counts(spark, sizes, test, valid):
    marked = split.stratified(rows(spark, *sizes))
    got = counts(marked, "split", "target")
    assert (got["test", 0], got["test", 1]) == test
    assert sum(got.values()) == sum(sizes)
    inner = counts(split.nested(marked.filter("split = 'train'").drop("split")), "inner", "target")
    assert (inner["valid", 0], inner["valid", 1]) == valid


GOLDEN = {
    "balanced_oversampling": ((597, 597), (909, 909)),
    "balanced_undersampling": ((190, 190), (462, 462)),
    "positive_5x_oversampling": ((597, 2985), (462, 2310)),
    "negative_5x_oversampling": ((950, 190), (4545, 909)),
    "positive_5x_undersampling": ((38, 190), (181, 909)),
    "negative_5x_undersampling": ((597, 119), (462, 92)),
    "none": ((597, 190), (462, 909)),
}


@pytest.mark.parametrize("scenario,ratio,method", resample.SCENARIOS)
def test_resampled_counts(spark, scenario, ratio, method):
    train = rows(spark, 597, 190, "a").unionByName(rows(spark, 462, 909, "b"))
    out = resample.to_ratio(train, ratio, method)
    got = counts(out, "dataset", "target")
    assert ((got["a", 0], got["a", 1]), (got["b", 0], got["b", 1])) == GOLDEN[scenario]
    source = {(r.dataset, r.row_id): r.target for r in train.collect()}
    copies = out.collect()
    assert all(source[r.dataset, r.row_id] == r.target for r in copies)
    assert len({(r.dataset, r.row_id, r.copy_no) for r in copies}) == len(copies)
    if method == "oversampling":
        kept = {(r.dataset, r.row_id) for r in copies}
        smaller = [k for k, t in source.items() if (k[0], t) in {("a", 0), ("b", 1)}]
        assert scenario != "balanced_oversampling" or all(k in kept for k in smaller if k[0] == "a")


def test_scenario_counts_need_only_class_counts(spark):
    table = resample.scenario_counts(rows(spark, 597, 190))
    got = {r.SamplingScenario: (r.TrainClass0_after_sampling, r.TrainClass1_after_sampling) for r in table.collect()}
    assert got == {k: v[0] for k, v in GOLDEN.items()}


def test_undersampling_keeps_at_least_five(spark):
    got = counts(resample.to_ratio(rows(spark, 100, 3), 1.0, "undersampling"), "target")
    assert (got[0,], got[1,]) == (5, 3)


def test_folds_are_balanced_and_shared_by_copies(spark):
    marked = split.kfold(rows(spark, 100, 41), 3)
    got = counts(marked, "target", "fold")
    assert sorted(got[0, f] for f in range(3)) == [33, 33, 34]
    assert sorted(got[1, f] for f in range(3)) == [13, 14, 14]
    grown = resample.to_ratio(marked, 1.0, "oversampling")
    assert grown.groupBy("row_id").agg(F.countDistinct("fold").alias("n")).filter("n > 1").count() == 0


def test_resampling_never_touches_test_rows(spark):
    marked = split.stratified(rows(spark, 300, 60))
    test = {r.row_id for r in marked.filter("split = 'test'").collect()}
    grown = resample.to_ratio(marked.filter("split = 'train'"), 5.0, "oversampling")
    assert not test & {r.row_id for r in grown.select("row_id").distinct().collect()}


def test_length_of_the_prefix_does_not_change_the_cuts(spark):
    data = rows(spark, 3000, 1000)

    def takes(totals):
        return totals.select("target", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("segment"), "n").select(
            "target", "segment", F.expr("case segment when 0 then 0 when 1 then n div 3 else n - 1 end").alias("take")
        )

    small = rank.assign_segments(data, ["target"], "row_id", 7, "x", takes)
    large = rank.assign_segments(data, ["target"], "row_id", 7, "x", takes, digits=2)
    assert small.exceptAll(large).count() == 0 and large.count() == 4000
    got = counts(large, "target", "segment")
    assert got == {(0, 1): 1000, (0, 2): 1999, (0, 3): 1, (1, 1): 333, (1, 2): 666, (1, 3): 1}


def test_rows_without_a_label_are_refused(spark):
    data = rows(spark, 30, 10).unionByName(spark.range(1).select(F.lit("d").alias("dataset"), F.lit(999).cast("long").alias("row_id"), F.lit(None).cast("int").alias("target")), allowMissingColumns=True)
    with pytest.raises(Exception, match="null in"):
        split.stratified(data).collect()


def test_a_single_class_is_left_as_it_is(spark):
    data = rows(spark, 0, 12)
    for method in ("oversampling", "undersampling"):
        assert resample.to_ratio(data, 1.0, method).count() == 12


def test_exact_rank_matches_a_window(spark):
    data = rows(spark, 500, 200).withColumn("key", order_key(1, "r", "row_id"))
    ranked = rank.exact_rank(data, ["target"], "key", "row_id", digits=1)
    by = {}
    for r in ranked.collect():
        by.setdefault(r.target, []).append((r["rank"], r.key))
    for pairs in by.values():
        assert [k for _, k in sorted(pairs)] == sorted(k for _, k in pairs)
        assert sorted(n for n, _ in pairs) == list(range(1, len(pairs) + 1))


def test_running_totals_cross_partitions(spark):
    data = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("hot").alias("g"), (F.col("id") * 7 % 5000).alias("o"), (F.col("id") % 5).alias("v")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rank.running_totals(data, ["g"], "o", ["v"])
        parts = got.select("g", "o", "v", "cum_v").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for g in ("a", "hot"):
        total = 0
        for r in sorted((r for r in parts if r.g == g), key=lambda r: -r.o):
            total += r.v
            want[g, r.o] = total
    assert len(parts) == 5000
    assert all(r.cum_v == want[r.g, r.o] for r in parts)


def test_class_weights(spark):
    got = {r.target: r.weight for r in resample.class_weights(resample.class_distribution(rows(spark, 30, 10))).collect()}
    assert got == {0: 40 / 60, 1: 40 / 20}
