"""Candidate tables, gains and progression over experiments scored from line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.catalog import common as C
from scoreloom.catalog import sql as S
from scoreloom.catalog.registry import query
from scoreloom.catalog.sampling import _space_sql
from scoreloom.operators import metrics, rank, report, search
from scoreloom.plans import steps
from scoreloom.session import materialise, scratch_path
from scoreloom.sources import delimited, store
from scoreloom.sources.tables import table

# experiment, score over line items, step, comparison, model, family, features, sampling
EXPERIMENTS = (
    ("quantity", "l_quantity / 50.0D", "03_feature_ablation", "Reference", "RandomForest", "RandomForest", "morgan", "none"),
    ("discount", "l_discount / 0.1D", "03_feature_ablation", "Best feature set", "RandomForest", "RandomForest", "desc", "none"),
    ("tax", "l_tax / 0.08D", "05_model_search", "", "ExtraTrees", "ExtraTrees", "desc", "none"),
    ("price", "l_extendedprice / 100000.0D", "05_model_search", "", "DecisionTree", "DecisionTree", "all_available", "none"),
    ("low_quantity", "1.0D - l_quantity / 50.0D", "08_advanced_ensemble", "Gatekeeper", "Tuned RF", "Gatekeeper", "desc", "balanced_oversampling"),
    ("low_discount", "1.0D - l_discount / 0.1D", "08_advanced_ensemble", "Best advanced ensemble", "Stacking", "SameFeatureAdvanced", "all_available", "balanced_oversampling"),
    ("low_tax", "1.0D - l_tax / 0.08D", "08_advanced_ensemble", "", "Voting", "SameFeatureAdvanced", "all_available", "balanced_oversampling"),
)
DATASETS = [f"line{i}" for i in range(1, 8)]
METRICS = ("ROC", "AP", "F1", "BalancedAccuracy")


def _measured(spark, sf):
    """(Dataset, experiment, metrics): seven scorers over the line items of each line number."""
    pairs = F.array(*[F.struct(F.lit(e[0]).alias("experiment"), F.expr(e[1]).alias("score")) for e in EXPERIMENTS])
    rows = table(spark, sf, "lineitem").select(
        F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("Dataset"),
        (F.col("l_returnflag") == "R").cast("int").alias("target"),
        F.inline(pairs),
    )
    measured = metrics.metric_rows(C.with_prediction(rows), ["Dataset", "experiment"])
    return materialise(C.rounded(measured, *METRICS, digits=9))


def _describe(measured, *columns):
    """Attach the experiment's fixed columns under the given names, in EXPERIMENTS order."""
    spots = {"Comparison": 3, "Model": 4, "Family": 5, "Features": 6, "Sampling": 7}
    names = F.col("experiment")
    out = measured
    for name, spot in columns:
        pairs = [F.lit(x) for e in EXPERIMENTS for x in (e[0], e[spots[spot]])]
        out = out.withColumn(name, F.try_element_at(F.create_map(*pairs), names))
    return out


def _step(measured, step):
    return measured.filter(F.col("experiment").isin([e[0] for e in EXPERIMENTS if e[2] == step]))


def _step_tables(measured):
    """Result tables as three steps write them, with different columns."""
    three = _describe(_step(measured, "03_feature_ablation"), ("Comparison", "Comparison"), ("ModelType", "Model"), ("FeatureSet", "Features"))
    five = _describe(_step(measured, "05_model_search"), ("ModelType", "Model"), ("FeatureSet", "Features"))
    eight = _describe(
        _step(measured, "08_advanced_ensemble"), ("Comparison", "Comparison"), ("ModelName", "Model"),
        ("ModelFamily", "Family"), ("FeatureStrategy", "Features"), ("SamplingScenario", "Sampling"),
    )
    return {
        "03_feature_ablation": three.select("Dataset", "Comparison", "ModelType", "FeatureSet", "ROC", "AP", "F1"),
        "05_model_search": five.select("Dataset", "ModelType", "FeatureSet", "ROC", "AP", "F1", "BalancedAccuracy"),
        "08_advanced_ensemble": eight.select("Dataset", "Comparison", "ModelName", "ModelFamily", "FeatureStrategy", "SamplingScenario", *METRICS),
    }


def _candidates(spark, sf):
    tables = _step_tables(_measured(spark, sf))
    return report.union_results([report.normalize(t, s, f"{s}.csv", DATASETS) for s, t in tables.items()])


def _label(e):
    generic = e[3] in ("Best advanced ensemble", "Gatekeeper")
    return (f"{e[3]}: {e[4]}" if generic else e[3]) or e[4]


_SCORES = "\n UNION ALL ".join(
    f"SELECT 'line' || l_linenumber AS dataset, CAST(l_returnflag = 'R' AS INTEGER) AS target, '{e[0]}' AS experiment, {e[1].replace('D', '::DOUBLE')} AS score FROM lineitem"
    for e in EXPERIMENTS
)
_VALUES = ", ".join(
    f"('{e[0]}', '{e[2]}', {report.STEP_ORDER[e[2]]}, '{_label(e)}', '{e[4]}', '{e[5]}', '{e[6]}', '{e[7]}', {'false' if e[2].startswith('03') else 'true'})"
    for e in EXPERIMENTS
)
_SQL = (
    f"WITH s AS ({_SCORES}),\npred AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM s),\n"
    + S.ladder("pred", "dataset, experiment") + ",\n" + S.metric_block("raw", "ladder", "dataset, experiment")
    + ",\nm AS (SELECT dataset AS \"Dataset\", experiment, " + ", ".join(f'round({c}, 9) AS "{c}"' for c in METRICS) + " FROM raw),\n"
    "cand AS (SELECT m.\"Dataset\", v.\"Step\", v.\"StepOrder\", v.\"CandidateLabel\", v.\"ModelName\", v.\"ModelFamily\", v.\"FeatureStrategy\", v.\"SamplingScenario\","
    " m.\"ROC\", m.\"AP\", m.\"F1\", CASE WHEN v.ba THEN m.\"BalancedAccuracy\" END AS \"BalancedAccuracy\", v.\"Step\" || '.csv' AS \"SourceFile\""
    f" FROM m JOIN (VALUES {_VALUES}) v(experiment, \"Step\", \"StepOrder\", \"CandidateLabel\", \"ModelName\", \"ModelFamily\", \"FeatureStrategy\", \"SamplingScenario\", ba) ON v.experiment = m.experiment),\n"
    "base AS (SELECT \"Dataset\", '02_rf_morgan_baseline' AS \"Step\", 2 AS \"StepOrder\", 'RF + Morgan baseline' AS \"CandidateLabel\", 'RandomForest' AS \"ModelName\", 'RandomForest' AS \"ModelFamily\","
    " 'morgan' AS \"FeatureStrategy\", 'none' AS \"SamplingScenario\", \"ROC\", \"AP\", \"F1\", \"BalancedAccuracy\", \"SourceFile\" FROM cand"
    " WHERE \"Step\" = '03_feature_ablation' AND \"CandidateLabel\" = 'Reference'),\n"
    "every AS (SELECT * FROM base UNION ALL SELECT * FROM cand),\n"
    "sel AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY \"Dataset\", \"Step\" ORDER BY \"ROC\" DESC, \"CandidateLabel\") AS place FROM every) WHERE place = 1),\n"
    "fin AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY \"Dataset\" ORDER BY \"StepOrder\" DESC) AS place FROM sel) WHERE place = 1)\n"
)
TIE = "CandidateLabel"
_DELTAS = tuple(f"{m}_Delta_vs_Previous_Selected" for m in report.COMPARED)


def _gain_sql(now: str, before: str, metric: str, delta: str, gain: str) -> str:
    return (
        f'round({now} - {before}, 6) AS "{metric}{delta}", '
        f'CASE WHEN abs({before}) > 1e-12 THEN round(100 * ({now} - {before}) / abs({before}), 6) END AS "{metric}{gain}"'
    )


@query(
    "collected_progression",
    _SQL + "SELECT * EXCLUDE (\"SourceFile\"), replace(\"SourceFile\", '.csv', '') AS \"SourceFile\", " + ", ".join(
        f'round("{m}" - lag("{m}") OVER (PARTITION BY "Dataset" ORDER BY "StepOrder"), 6) AS "{m}_Delta_vs_Previous_Selected"' for m in report.COMPARED
    ) + " FROM sel",
)
def collected_progression(spark, sf):
    """The step tables written as files, read back through their alternatives, and reported."""
    base = scratch_path(spark, "steps")
    sources = {}
    for step, rows in _step_tables(_measured(spark, sf)).items():
        rows.write.parquet(f"{base}/{step}")
        sources[step] = [f"{base}/absent.csv", f"{base}/{step}"]
    out = steps.collect(spark, sources, DATASETS, tie=TIE)["progression"]
    out = out.withColumn("SourceFile", F.substring_index("SourceFile", "/", -1))
    return C.rounded(out, *_DELTAS)


@query("candidate_normalize", _SQL + "SELECT * FROM cand")
def candidate_normalize(spark, sf):
    return _candidates(spark, sf)


def _with_baseline(spark, sf):
    candidates = _candidates(spark, sf)
    return report.baseline_lift(candidates, ordinal=TIE).unionByName(candidates)


@query("baseline_lift", _SQL + "SELECT * FROM base")
def baseline_lift(spark, sf):
    return report.baseline_lift(_candidates(spark, sf), ordinal=TIE)


@query("candidates_sorted", _SQL + 'SELECT * FROM every ORDER BY "Dataset", "ROC" DESC')
def candidates_sorted(spark, sf):
    return _with_baseline(spark, sf).orderBy("Dataset", F.col("ROC").desc())


@query("progression_by_step", _SQL + 'SELECT * FROM sel ORDER BY "Dataset", "StepOrder"')
def progression_by_step(spark, sf):
    return report.progression(_with_baseline(spark, sf), TIE).orderBy("Dataset", "StepOrder")


@query("final_candidate", _SQL + "SELECT * FROM fin")
def final_candidate(spark, sf):
    return report.final_candidate(report.progression(_with_baseline(spark, sf), TIE))


@query(
    "progression_deltas",
    _SQL + "SELECT *, " + ", ".join(
        f'round("{m}" - lag("{m}") OVER (PARTITION BY "Dataset" ORDER BY "StepOrder"), 6) AS "{d}"' for m, d in zip(report.COMPARED, _DELTAS)
    ) + " FROM sel",
)
def progression_deltas(spark, sf):
    return C.rounded(report.progression_deltas(report.progression(_with_baseline(spark, sf), TIE)), *_DELTAS)


@query(
    "baseline_vs_final",
    _SQL + 'SELECT b."Dataset", b."Step" AS "BaselineStep", b."CandidateLabel" AS "BaselineCandidate", b."ModelName" AS "BaselineModel", b."FeatureStrategy" AS "BaselineFeatureStrategy",'
    ' b."SamplingScenario" AS "BaselineSamplingScenario", f."Step" AS "FinalStep", f."CandidateLabel" AS "FinalCandidate", f."ModelName" AS "FinalModel", f."ModelFamily" AS "FinalModelFamily",'
    ' f."FeatureStrategy" AS "FinalFeatureStrategy", f."SamplingScenario" AS "FinalSamplingScenario", '
    + ", ".join(f'b."{m}" AS "Baseline_{m}", f."{m}" AS "Final_{m}", ' + _gain_sql(f'f."{m}"', f'b."{m}"', m, "_Delta", "_Gain_%") for m in report.COMPARED)
    + ' FROM base b JOIN fin f ON f."Dataset" = b."Dataset"',
)
def baseline_vs_final(spark, sf):
    candidates = _with_baseline(spark, sf)
    baseline = candidates.filter(F.col("Step") == report.BASELINE_STEP)
    out = report.baseline_vs_final(baseline, report.final_candidate(report.progression(candidates, TIE)))
    return C.rounded(out, *[f"{m}{x}" for m in report.COMPARED for x in ("_Delta", "_Gain_%")])


@query(
    "gain_vs_previous",
    _SQL + ", prev AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY \"Dataset\" ORDER BY \"ROC\" DESC, \"CandidateLabel\") AS place FROM cand WHERE \"Step\" = '03_feature_ablation') WHERE place = 1)\n"
    'SELECT c."Dataset", c."ModelName", c."ROC", c."AP", c."F1", \'model search\' AS "CurrentStep", \'feature ablation\' AS "ComparedWith", '
    + ", ".join(f'p."{m}" AS "Previous_{m}", ' + _gain_sql(f'c."{m}"', f'p."{m}"', m, "_Delta", "_Gain_%") for m in report.COMPARED)
    + " FROM cand c LEFT JOIN prev p ON p.\"Dataset\" = c.\"Dataset\" WHERE c.\"Step\" = '05_model_search'",
)
def gain_vs_previous(spark, sf):
    candidates = _candidates(spark, sf)
    current = candidates.filter("Step = '05_model_search'").select("Dataset", "ModelName", "ROC", "AP", "F1")
    previous = candidates.filter("Step = '03_feature_ablation'")
    out = report.gain(current, previous, "model search", "feature ablation", TIE)
    return C.rounded(out, *[f"{m}{x}" for m in report.COMPARED for x in ("_Delta", "_Gain_%")])


@query(
    "reference_vs_best",
    _SQL + ", ref AS (SELECT * FROM cand WHERE \"CandidateLabel\" = 'Reference'),\n"
    "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY \"Dataset\" ORDER BY \"ROC\" DESC, \"CandidateLabel\") AS place FROM cand WHERE \"Step\" = '05_model_search') WHERE place = 1)\n"
    'SELECT "Dataset", \'Gatekeeper RF\' AS "Comparison", "ModelName", "FeatureStrategy", "ROC", "AP", "F1", '
    + ", ".join(f'0.0::DOUBLE AS "{m}_Delta_vs_Gatekeeper", 0.0::DOUBLE AS "{m}_Gain_%"' for m in report.COMPARED)
    + ' FROM ref UNION ALL SELECT b."Dataset", \'Best model\', b."ModelName", b."FeatureStrategy", b."ROC", b."AP", b."F1", '
    + ", ".join(_gain_sql(f'b."{m}"', f'r."{m}"', m, "_Delta_vs_Gatekeeper", "_Gain_%") for m in report.COMPARED)
    + ' FROM best b JOIN ref r ON r."Dataset" = b."Dataset"',
)
def reference_vs_best(spark, sf):
    columns = ["Dataset", "ModelName", "FeatureStrategy", "ROC", "AP", "F1"]
    candidates = _candidates(spark, sf)
    reference = candidates.filter("CandidateLabel = 'Reference'").select(*columns)
    others = candidates.filter("Step = '05_model_search'").select(*columns, TIE)
    out = report.reference_vs_best(reference, others, "Gatekeeper RF", "Best model", TIE)
    return C.rounded(out, *[f"{m}{x}" for m in report.COMPARED for x in ("_Delta_vs_Gatekeeper", "_Gain_%")])


@query("best_per_group", _SQL + 'SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY "Dataset" ORDER BY "ROC" DESC, "CandidateLabel") AS place FROM cand) WHERE place = 1')
def best_per_group(spark, sf):
    return rank.best_per_group(_candidates(spark, sf), ["Dataset"], "ROC", TIE)


_PLACE = " ".join(f"WHEN '{e[0]}' THEN {i}" for i, e in enumerate(EXPERIMENTS))


@query(
    "best_in_input_order",
    _SQL + f', placed AS (SELECT "Dataset", experiment, round("ROC", 1) AS "ROC", CASE experiment {_PLACE} END AS place FROM m)\n'
    "SELECT kind AS \"Kind\", \"Dataset\", experiment, \"ROC\" FROM (SELECT *, row_number() OVER (PARTITION BY \"Dataset\" ORDER BY \"ROC\" DESC, place) AS first FROM placed)"
    " CROSS JOIN (SELECT unnest(['parquet', 'csv', 'results']) AS kind) WHERE first = 1",
)
def best_in_input_order(spark, sf):
    """The best experiment of each dataset by a coarse ROC, the first in its files of equal ones.

    The rows are written in the order of the experiments, as tables of several files, and read back.
    """
    place = F.array_position(F.array(*[F.lit(e[0]) for e in EXPERIMENTS]), F.col("experiment"))
    rows = C.rounded(_measured(spark, sf), "ROC", digits=1).select("Dataset", "experiment", "ROC", place.alias("place"))
    ordered = rows.repartitionByRange(4, "place", "Dataset").sortWithinPartitions("place", "Dataset").drop("place")
    base = scratch_path(spark, "ordered")
    ordered.write.parquet(f"{base}/rows")
    ordered.write.option("header", True).csv(f"{base}/rows.csv")
    store.write_results(ordered, f"{base}/results", "05_model_search")
    found, _ = delimited.first_available(spark, {"parquet": [f"{base}/rows"], "csv": [f"{base}/rows.csv"]}, ordered=True)
    found["results"] = store.read_results(spark, f"{base}/results", "05_model_search")
    best = [
        rank.best_per_group(df.withColumn("ROC", F.col("ROC").cast("double")), ["Dataset"], "ROC").select(
            F.lit(kind).alias("Kind"), "Dataset", "experiment", "ROC"
        )
        for kind, df in found.items()
    ]
    return report.union_results(best)


@query("candidate_rank", _SQL + 'SELECT "Dataset", "CandidateLabel", "ROC", CAST(row_number() OVER (PARTITION BY "Dataset" ORDER BY "ROC" DESC, "CandidateLabel") AS INTEGER) AS "CandidateRank" FROM cand')
def candidate_rank(spark, sf):
    return rank.candidate_rank(_candidates(spark, sf), ["Dataset"], "ROC", TIE).select("Dataset", TIE, "ROC", "CandidateRank")


@query("best_challenger", _SQL + "SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY \"Dataset\" ORDER BY \"ROC\" DESC, \"CandidateLabel\") AS place FROM cand WHERE \"ModelFamily\" <> 'Gatekeeper') WHERE place = 1")
def best_challenger(spark, sf):
    return report.best_challenger(_candidates(spark, sf), ordinal=TIE)


@query("top_n_metric", _SQL + 'SELECT "Dataset", "CandidateLabel", "ROC" FROM cand ORDER BY "ROC" DESC, "Dataset", "CandidateLabel" LIMIT 10')
def top_n_metric(spark, sf):
    return report.top_n(_candidates(spark, sf), "ROC", 10, ["Dataset", TIE]).select("Dataset", TIE, "ROC")


@query(
    "union_results",
    _SQL + "SELECT \"Dataset\", CASE WHEN \"Step\" = '05_model_search' THEN NULL WHEN \"CandidateLabel\" LIKE '%: %' THEN split_part(\"CandidateLabel\", ': ', 1) WHEN \"ModelName\" = 'Voting' THEN '' ELSE \"CandidateLabel\" END AS \"Comparison\","
    " CASE WHEN \"Step\" <> '08_advanced_ensemble' THEN \"ModelName\" END AS \"ModelType\", CASE WHEN \"Step\" = '08_advanced_ensemble' THEN \"ModelName\" END AS \"ModelName\", \"ROC\", \"BalancedAccuracy\" FROM cand",
)
def union_results(spark, sf):
    """The three step tables stacked as they are, absent columns null."""
    merged = report.union_results(list(_step_tables(_measured(spark, sf)).values()))
    return merged.select("Dataset", "Comparison", "ModelType", "ModelName", "ROC", "BalancedAccuracy")


@query(
    "candidate_labels",
    _SQL + ", d AS (SELECT source AS dataset, count(*) AS rows FROM documents GROUP BY source),\n"
    "k AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY md5('42:params:' || dataset || ':' || combo), combo) AS rn FROM (SELECT dataset, unnest(range(3600)) AS combo FROM d)),\n"
    f"p AS (SELECT dataset, rn, {_space_sql()} FROM k WHERE rn <= 10)\n"
    "SELECT dataset, 'rank ' || rn || ' | n=' || n_estimators || ' | depth=' || max_depth || ' | leaf=' || min_samples_leaf || ' | feat=' || max_features AS label FROM p"
    " UNION ALL SELECT \"Dataset\", string_agg(\"ModelName\", ' + ' ORDER BY place) FROM (SELECT *, row_number() OVER (PARTITION BY \"Dataset\" ORDER BY \"ROC\" DESC, \"CandidateLabel\") AS place FROM cand) WHERE place <= 4 GROUP BY \"Dataset\"",
)
def candidate_labels(spark, sf):
    """Labels of sampled settings per document source, and of the four best candidates per dataset."""
    sources = table(spark, sf, "documents").groupBy(F.col("source").alias("dataset")).agg(F.count(F.lit(1)).alias("rows"))
    sampled = search.sample_params_by(sources, "dataset", 10, place="rn")
    settings = sampled.select(
        "dataset",
        search.candidate_label(F.col("rn"), F.col("n_estimators"), F.col("max_depth"), F.col("min_samples_leaf"), F.col("max_features")).alias("label"),
    )
    ranked = rank.candidate_rank(_candidates(spark, sf), ["Dataset"], "ROC", TIE, "place").filter("place <= 4")
    joined = ranked.groupBy(F.col("Dataset").alias("dataset")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "ModelName"))), lambda s: s["ModelName"]), " + ").alias("label")
    )
    return settings.unionByName(joined)
