"""Delimited reading, coercion, imputation and scaling."""

import statistics

import pytest
from pyspark.sql import functions as F

from scoreloom.functions.numeric import clean_array, float32_or_zero, to_class, to_number
from scoreloom.operators import clean
from scoreloom.sources import delimited


def write(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_text(text, encoding=encoding)
    return str(path)


@pytest.mark.parametrize("sep", [";", ","])
def test_separator_and_byte_order_mark(spark, tmp_path, sep):
    path = write(tmp_path, "a.csv", f"id{sep}text\n1{sep}x\n2{sep}y\n", "utf-8-sig")
    df, found = delimited.read_delimited(spark, path)
    assert found == sep and df.columns == ["id", "text"]
    assert sorted(r.text for r in df.collect()) == ["x", "y"]


def test_single_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        delimited.read_delimited(spark, write(tmp_path, "b.csv", "id\n1\n"))


def test_first_available_skips_missing_and_empty(spark, tmp_path):
    empty = write(tmp_path, "empty.csv", "a,b\n")
    good = write(tmp_path, "good.csv", "a;b\n1;2\n3;4\n")
    found, report = delimited.first_available(spark, {"s": [str(tmp_path / "none.csv"), empty, good], "m": [empty]})
    rows = {r.Step: r for r in report.collect()}
    assert (rows["s"].Status, rows["s"].Rows, rows["s"].SourceUsed) == ("OK", 2, good)
    assert (rows["m"].Status, rows["m"].Rows) == ("MISSING", 0)
    assert set(found) == {"s"}


def test_target_coercion(spark):
    texts = ["1", "0.7", "-1.9", " 0 ", "abc", "", "1d", "1e1", None, "NaN", "99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(to_class(F.col("t"))).collect()] == [1, 0, -1, 0, None, None, None, 10, None, None, None]
    assert df.select(to_number(F.col("t"))).collect()[1][0] == 0.7


def test_array_and_float_rules(spark):
    bad = [1.0, float("nan"), float("inf"), None, 1e300]
    df = spark.createDataFrame([(bad,)], "v array<double>")
    row = df.select(clean_array(F.col("v")).alias("z"), clean_array(F.col("v"), "null").alias("n"), F.transform("v", float32_or_zero).alias("f")).first()
    assert row.z == [1.0, 0.0, 0.0, 0.0, 1e300]
    assert row.n == [1.0, None, None, None, 1e300]
    assert row.f == [1.0, 0.0, 0.0, 0.0, 0.0]


@pytest.mark.parametrize("bracketed", [0, 500, 10**9])
def test_median_agrees_with_brute_force(spark, bracketed):
    data = spark.range(20_001).select(
        F.explode(
            F.array(
                F.struct(F.lit("skewed").alias("g"), F.exp(F.col("id") % 997 / 40.0).alias("x")),
                F.struct(F.lit("hot").alias("g"), F.when(F.col("id") % 5 < 2, 3.0).otherwise(F.col("id") % 7 * 1.0).alias("x")),
                F.struct(F.lit("even").alias("g"), F.when(F.col("id") > 0, F.col("id") * 1.0).alias("x")),
                F.struct(F.lit("one").alias("g"), F.when(F.col("id") == 4, F.lit(8.0)).alias("x")),
            )
        ).alias("s")
    ).select("s.g", "s.x")
    want = {}
    for r in data.filter("x is not null").collect():
        want.setdefault(r.g, []).append(r.x)
    got = {r.g: r.median for r in clean.exact_median(data, ["g"], bracketed).collect()}
    assert got == {g: statistics.median(v) for g, v in want.items()}


def test_medians_ignore_test_rows_and_drop_empty_columns(spark):
    train = spark.createDataFrame([("d", [1.0, None, 4.0]), ("d", [3.0, None, None]), ("d", [None, None, 8.0])], "dataset string, v array<double>")
    test = spark.createDataFrame([("d", [None, 5.0, None])], train.schema)
    filled = clean.apply_median(test, "v", clean.fit_median(train, "v"))
    assert filled.first().v == [2.0, 6.0]


def test_standard_scaling_uses_population_deviation(spark):
    train = spark.createDataFrame([("d", [1.0, 5.0]), ("d", [3.0, 5.0])], "dataset string, v array<double>")
    moments = clean.column_moments(train, "v")
    assert [r.v for r in clean.rescale(train, "v", moments).collect()] == [[-1.0], [1.0]]
    assert [r.v for r in clean.rescale(train, "v", moments, "minmax").collect()] == [[0.0], [1.0]]


def test_misaligned_families_are_refused(spark):
    df = spark.createDataFrame([([1], [1.0]), ([2], None)], "a array<int>, b array<double>")
    with pytest.raises(ValueError):
        clean.require_alignment(df, ["a", "b"])
    assert clean.require_alignment(df.filter("b is not null"), ["a", "b"]).count() == 1


def test_quoted_header_quotes_and_line_ends(spark, tmp_path):
    path = write(tmp_path, "q.csv", 'id,"a;b",c\n1,"two\nlines","say ""hi"""\n2,x,y\n')
    df, sep = delimited.read_delimited(spark, path, multi_line=True)
    assert sep == "," and df.columns == ["id", "a;b", "c"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "two\nlines", 'say "hi"'), ("2", "x", "y")]


def test_sparse_median_is_that_of_the_dense_rows(spark):
    """Bits, negative cells, missing cells, features never or always missing, and middles between zero and a cell."""
    import random
    from statistics import median

    rng = random.Random(3)
    draw = [lambda: rng.choice([0, 0, 0, 1]), lambda: rng.gauss(0, 2), lambda: rng.choice([0, -1, -2, -3]), lambda: rng.choice([0, 1]), lambda: 0, lambda: None, lambda: rng.choice([0, 4, None])]
    for n in (1, 2, 7, 40):
        rows = [[d() for d in draw] for _ in range(n)]
        cells = [("d", j, None if v is None else float(v)) for row in rows for j, v in enumerate(row) if v != 0]
        df = spark.createDataFrame(cells, "dataset string, idx int, x double")
        sizes = spark.createDataFrame([("d", n)], "dataset string, n long")
        got = {r.idx: r.median for r in clean.sparse_median(df, sizes).collect()}
        for j in range(len(draw)):
            there = [row[j] for row in rows if row[j] is not None]
            want = median(there) if there else None
            assert got.get(j, 0.0) == want, (n, j)


def test_missing_values_by_policy(spark):
    rows = spark.createDataFrame([("d", 0, [1.0, None, float("nan")]), ("d", 1, [3.0, None, 5.0]), ("d", 2, [float("inf"), 2.0, None])], "dataset string, row_id int, v array<double>")
    train = rows.filter("row_id < 2")
    by = lambda df: {r.row_id: r.v for r in df.collect()}
    assert by(clean.filled(rows, "v")) == {0: [1.0, 0.0, 0.0], 1: [3.0, 0.0, 5.0], 2: [0.0, 2.0, 0.0]}
    assert by(clean.filled(rows, "v", "median", train)) == {0: [1.0, 0.0, 5.0], 1: [3.0, 0.0, 5.0], 2: [2.0, 2.0, 5.0]}


def test_medians_of_equal_cells_follow_from_their_counts(spark, monkeypatch):
    columns = {0: [1.0] * 7 + [0.0], 1: [1.0] * 4 + [0.0] * 4, 2: [-2.0] * 5 + [3.0, 0.0, 0.0], 3: [1.0] * 5 + [None] * 3}
    data = [("d", i, x) for i, column in columns.items() for x in column if x != 0]
    df, sizes = spark.createDataFrame(data, "dataset string, idx int, x double"), spark.createDataFrame([("d", 8)], "dataset string, n long")
    ordered, whole = [], clean.exact_median
    monkeypatch.setattr(clean, "exact_median", lambda cells, *rest: ordered.append(cells.count()) or whole(cells, *rest))
    assert {r.idx: r.median for r in clean.sparse_median(df, sizes).collect()} == {0: 1.0, 1: 0.5, 2: -2.0, 3: 1.0}
    assert ordered == [0]
