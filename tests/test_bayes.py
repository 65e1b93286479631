"""Naive Bayes from stored cells against dense arrays."""

import random

import numpy as np
from pyspark.sql import functions as F

from scoreloom.operators import bayes


def test_stored_cells_say_the_same_as_dense_rows(spark):
    rng = random.Random(6)
    rows = [("d", i, int(i % 3 == 0), [rng.gauss(i % 3, 1.0), float(rng.random() < 0.2), 0.0, rng.choice([0.0, 5.0])]) for i in range(90)]
    df = spark.createDataFrame(rows, "dataset string, row_id long, target int, values array<double>").cache()
    cells = df.select("dataset", "row_id", "target", F.posexplode("values").alias("idx", "x")).filter("x <> 0")
    model = bayes.fit_cells(cells, df.groupBy("dataset", "target").agg(F.count("*").alias("n")))
    sparse = {r.row_id: r.odds for r in bayes.score_cells(df.select("dataset", "row_id"), cells.drop("target"), model).collect()}
    x, y = np.array([r[3] for r in rows]), np.array([r[2] for r in rows])
    least = 1e-9 * x.var(0).max()

    def said(c):
        v = x[y == c].var(0) + least
        return np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * v) + (x - x[y == c].mean(0)) ** 2 / v).sum(1)

    assert np.allclose([sparse[i] for i in range(90)], said(1) - said(0), rtol=1e-8)


def test_a_row_without_cells_has_the_odds_of_zeros(spark):
    rows = spark.createDataFrame([("d", i, i % 2) for i in range(8)], "dataset string, row_id long, target int")
    cells = spark.createDataFrame([("d", i, i % 2, 0, float(i)) for i in range(1, 8)], "dataset string, row_id long, target int, idx int, x double")
    model = bayes.fit_cells(cells, rows.groupBy("dataset", "target").agg(F.count("*").alias("n")))
    got = {r.row_id: r.odds for r in bayes.score_cells(rows, cells.drop("target"), model).collect()}
    assert len(got) == 8 and got[0] == model[1].first().base
