"""Queries of trained models on tables made here."""

from scoreloom import catalog
from scoreloom.catalog.common import FAMILIES
from scoreloom.operators import models


def test_gbt_grows_all_rounds_over_all_families(spark, tmp_path, monkeypatch):
    """One target is told by two words of like letters alone, which neither keys nor descriptors see."""
    docs = [(i, f"some {'peach' if i % 3 else 'cheap'} on row {i % 7}{' end' * (i % 2)}") for i in range(90)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    marks = [(i, i % 2, int(i % 3 == 0)) for i in range(90)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    fitted, whole = [], models.fit
    monkeypatch.setattr(models, "fit", lambda *a, **k: fitted.append(whole(*a, **k)) or fitted[-1])
    table = {r.Dataset: r for r in catalog.queries()["gbt"](spark, str(tmp_path)).collect()}
    width = sum(f.size for f in FAMILIES)
    assert len(FAMILIES) == 4 and [(f.model.getNumTrees, f.model.numFeatures) for f in fitted] == [(100, width)] * 2
    assert set(table) == {"quality", "toxic"} and {(r.Status, r.ModelType) for r in table.values()} == {("OK", "GradientBoosting")}
    assert {r.TN + r.FP + r.FN + r.TP for r in table.values()} == {18} and table["toxic"].ROC == 1.0
