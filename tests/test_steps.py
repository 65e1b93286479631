"""The experiment steps end to end on the smallest tables."""

import json

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import featurize, rank, search
from scoreloom.plans import chain, steps
from scoreloom.sources import delimited, store
from scoreloom.sources.tables import by_target, labelled_documents

FAMILIES = [f for f in featurize.text_families() if f.name in ("keys", "desc")]
FAST = {"trees": 4, "depth": 3}


@pytest.fixture(scope="module")
def rows(spark):
    docs = labelled_documents(spark, "/root/testdata/sf0.001")
    return steps.prepare(by_target(featurize.featurize(docs, FAMILIES).drop("text")), FAMILIES)


def test_parts_are_disjoint(rows):
    got = {w: {r.row_id for r in steps.part(rows, "quality", w).collect()} for w in ("train", "test", "fit", "valid")}
    assert got["fit"] | got["valid"] == got["train"] and not got["fit"] & got["valid"]
    assert not got["train"] & got["test"] and all(got.values())


def test_selection_on_validation_rows(rows):
    table = steps.ablation(rows, FAMILIES, ["quality"], sets=["desc"], params=FAST, select_on="valid").first()
    held = steps.part(rows, "quality", "valid").count()
    assert table.TN + table.FP + table.FN + table.TP == held


def test_feature_sets_share_vectors_that_are_written_once(rows, monkeypatch):
    written, stored = [], steps.stored
    monkeypatch.setattr(steps, "stored", lambda df, name, **kw: written.append(name) or stored(df, name, **kw))
    table = steps.ablation(rows, FAMILIES, ["quality"], sets=["keys", "desc", "keys_desc"], params=FAST)
    assert written == ["vectors"] and {r.Status for r in table.collect()} == {"OK"}
    vectors = steps.family_vectors(rows, FAMILIES)
    for name in ("desc", "keys_desc"):
        chosen = featurize.select_families(FAMILIES, name)
        key = ("row_id", "dataset")
        got, want = (df.orderBy(*key).collect() for df in (steps.input_of(vectors, chosen), steps.assembled(rows, chosen)))
        assert [r.asDict() for r in got] == [r.asDict() for r in want]


def test_tuning_names_the_settings_that_it_fits(rows):
    ready = steps.assembled(rows, FAMILIES)
    space = {**search.FOREST_SPACE, "n_estimators": (4,), "max_depth": (3,), "min_samples_leaf": (1,), "max_features": ("sqrt",)}
    for r in steps.tuning(ready, "quality", 1.0, "none", n=2, space=space).collect():
        params = json.loads(r.Params)
        assert (params["trees"], params["depth"]) == (4, 3) and "n=4 | depth=3" in r.CandidateLabel


def test_rows_that_only_some_families_have_are_refused(spark, rows):
    docs = labelled_documents(spark, "/root/testdata/sf0.001")
    bad = by_target(featurize.featurize(docs, FAMILIES).drop("text")).withColumn("desc", F.when(F.col("row_id") > 5, F.col("desc")))
    with pytest.raises(ValueError):
        steps.prepare(bad, FAMILIES)


def test_collected_steps_have_the_baseline_of_the_ablation(spark, rows, tmp_path):
    table = steps.ablation(rows, FAMILIES, ["quality"], sets=["keys", "desc"], params=FAST)
    table.write.parquet(str(tmp_path / "three"))
    out = steps.collect(spark, {"03_feature_ablation": [str(tmp_path / "three")]}, ["quality"])
    first, second = out["progression"].orderBy("StepOrder").collect()
    reference = table.filter("Comparison = 'Reference'").first()
    assert (first.StepOrder, first.ROC, reference.FeatureSet) == (2, reference.ROC, FAMILIES[0].name)
    assert second.StepOrder == 3 and second.ROC >= first.ROC


def test_first_row_of_a_table_wins_a_tie(spark, tmp_path):
    path = tmp_path / "five.csv"
    path.write_text("Dataset,Comparison,ModelType,ROC,AP,F1\na,Gatekeeper RF,RandomForest,0.9,0.7,0.6\na,Best 12-model result,RandomForest,0.9,0.7,0.6\n")
    out = steps.collect(spark, {"05_model_search": [str(path)]}, ["a"])
    assert out["progression"].first().CandidateLabel == "Gatekeeper RF"


def test_first_row_of_many_files_wins_a_tie(spark, tmp_path):
    """Files of unlike size, so that tasks do not read them in the order of their names."""
    best = [("Gatekeeper RF", 1), ("Second", 900), ("Best 12-model result", 5000)]
    for n, kind in enumerate(("parquet", "csv")):
        folder = str(tmp_path / f"five.{kind}")
        for i, (label, copies) in enumerate(best):
            part = spark.createDataFrame([("a", label, "RandomForest", 0.9)] * copies, "Dataset string, Comparison string, ModelType string, ROC double")
            part.coalesce(1).write.mode("append").option("header", True).format(kind).save(f"{folder}/part={i}")
        out = steps.collect(spark, {"05_model_search": [folder]}, ["a"])
        assert out["progression"].first().CandidateLabel == "Gatekeeper RF"
        ordered = delimited.read_any(spark, folder, ordered=True).orderBy(rank.INPUT_ORDER).select("Comparison").collect()
        assert [r[0] for r in ordered] == [label for label, copies in best for _ in range(copies)]


def test_ties_without_any_order_are_settled_by_value(spark):
    rows = [("a", 0.9, label) for label in ("z", "b", "q")] * 3
    for n in (1, 4):
        df = spark.createDataFrame(rows, "Dataset string, ROC double, Label string").repartition(n)
        assert rank.best_per_group(df, ["Dataset"]).first().Label == "b"


def test_broken_table_falls_back(spark, tmp_path):
    spark.range(100).withColumn("ROC", F.lit(0.5)).repartition(2).write.parquet(str(tmp_path / "broken"))
    file = max((tmp_path / "broken").glob("part-*.parquet"))
    file.write_bytes(file.read_bytes()[:200])
    for crc in (tmp_path / "broken").glob(".*.crc"):
        crc.unlink()
    (tmp_path / "good.csv").write_text('Dataset;ROC;Note\na;0.5;"two\nlines"\n')
    found, report = delimited.first_available(spark, {"s": [str(tmp_path / "broken"), str(tmp_path / "good.csv")]}, multi_line=True)
    assert report.first().SourceUsed.endswith("good.csv") and [r.Note for r in found["s"].collect()] == ["two\nlines"]


def test_ensemble_rows(rows):
    table = steps.ensembles(
        rows, FAMILIES, "quality", "keys_desc", 1.0, "oversampling", FAST, trees=4, rounds=2, views=("keys", "desc"), keep=2
    ).collect()
    assert len(table) == 8
    assert all(r.ROC is None or 0.0 <= r.ROC <= 1.0 for r in table)
    assert {r.ModelFamily for r in table} == {"Gatekeeper", "SameFeatureAdvanced", "FeatureSetEnsemble", "MultiView"}


def test_collect_needs_a_source(spark, tmp_path):
    with pytest.raises(RuntimeError):
        steps.collect(spark, {"05_model_search": [str(tmp_path / "none.csv")]}, ["a"])


def test_collect_reads_delimited_results(spark, tmp_path):
    path = tmp_path / "three.csv"
    path.write_text("Dataset,Comparison,ModelType,FeatureSet,ROC,AP,F1\na,Reference,RandomForest,morgan,0.8,0.7,0.6\na,Best feature set,RandomForest,desc,0.9,0.8,\n")
    out = steps.collect(spark, {"03_feature_ablation": [str(path)], "07_tuning": [str(tmp_path / "none.csv")]}, ["a"])
    assert {r.Step: r.Status for r in out["source_report"].collect()} == {"03_feature_ablation": "OK", "07_tuning": "MISSING"}
    got = out["progression"].orderBy("StepOrder").collect()
    assert [(r.StepOrder, r.ROC, r.F1) for r in got] == [(2, 0.8, 0.6), (3, 0.9, None)]
    assert out["final"].first().CandidateLabel == "Best feature set"
    assert out["baseline_vs_final"].first()["ROC_Gain_%"] == pytest.approx(12.5)


def small(**more):
    return chain.Settings(
        sets=("keys", "desc"), methods=("ANOVA",), ks=(5, 10), models=("RandomForest", "DecisionTree"), forest=FAST,
        model_params={"RandomForest": FAST}, scenarios=search_scenarios(), candidates=1, space={**search.FOREST_SPACE, "n_estimators": (4,), "max_depth": (3,)},
        trees=4, rounds=2, views=("keys", "desc"), keep=2, **more,
    )


def search_scenarios():
    from scoreloom.operators import resample

    return tuple(s for s in resample.SCENARIOS if s[0] in ("none", "balanced_oversampling", "balanced_undersampling"))


def test_each_step_takes_what_the_one_before_chose(spark, rows, tmp_path, monkeypatch):
    """And a run that is stopped goes on with the step that had not ended."""
    base, calls, whole = str(tmp_path / "chain"), [], steps.ensembles
    monkeypatch.setattr(steps, "ensembles", lambda *a, **k: calls.append(a) or (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        chain.run(rows, FAMILIES, ["quality"], base, small())
    config = {r.Step: r for r in (chain.read_config(spark, base, step).first() for step in (chain.ABLATION, chain.SELECTION, chain.RESAMPLING, chain.TUNING))}
    three = store.read_results(spark, f"{base}/results", chain.ABLATION).collect()
    assert config[chain.ABLATION].FeatureSet == max(three, key=lambda r: r.ROC).FeatureSet
    four = store.read_results(spark, f"{base}/results", chain.SELECTION).collect()
    assert json.loads(config[chain.SELECTION].Features) == json.loads(max(four, key=lambda r: r.ROC).Features)
    family, ratio, method, forest = calls[0][3:7]
    assert family == config[chain.ABLATION].FeatureSet == config[chain.TUNING].FeatureSet
    assert method == config[chain.RESAMPLING].SamplingMethod and forest == json.loads(config[chain.TUNING].Params)

    monkeypatch.setattr(steps, "ablation", None)  # ended steps are not run again
    monkeypatch.setattr(steps, "ensembles", whole)
    out = chain.run(rows, FAMILIES, ["quality"], base, small())
    progress = out["progression"].orderBy("StepOrder").collect()
    assert [r.StepOrder for r in progress] == [2, 3, 4, 5, 6, 7, 8]
    best = {r.Step: r.ROC for r in out["config"].collect()}
    assert all(r.ROC == pytest.approx(best[r.Step]) for r in progress[1:])
    assert {r.CurrentStep for r in out["gains"].collect()} == {chain.SELECTION, chain.COMPARISON, chain.RESAMPLING, chain.TUNING, chain.ENSEMBLES}
