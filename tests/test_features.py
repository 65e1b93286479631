"""Text features against plain Python, family rules and scores on small fixtures."""

import hashlib
import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scoreloom.functions import text as T
from scoreloom.operators import bayes, featurize, neighbors, resample, score

TEXTS = ["The cat sat. The cat ran!", "é😀x yz", "  ", "", "one", "A\nA\nB 12", "tab\tand\nline " * 5]


def slot(gram, bits):
    return int(hashlib.md5(gram.encode()).hexdigest()[:15], 16) % bits


def tokens(text):
    for blank in "\t\n\r\f":
        text = text.replace(blank, " ")
    return [t for t in text.split(" ") if t]


def test_bits_match_plain_python(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    c = F.col("t")
    rows = df.select("t", T.ngram_bits(c, bits=64).alias("w"), T.chargram_bits(c, bits=64).alias("c"), T.key_bits(c, ("cat", "[0-9]")).alias("k")).collect()
    for r in rows:
        words = tokens(r.t)
        if not words:
            assert r.w is None and r.c is None and r.k is None
            continue
        grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        assert r.w == sorted({slot(g, 64) for g in grams})
        assert r.c == sorted({slot(r.t[i : i + 4], 64) for i in range(len(r.t) - 3)})
        assert r.k == [i for i, hit in enumerate(("cat" in r.t, any(ch.isdigit() for ch in r.t))) if hit]


def test_descriptors_match_plain_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for r in df.select("t", T.descriptors(F.col("t")).alias("d")).collect():
        words = tokens(r.t)
        if not words:
            assert r.d is None
            continue
        got = dict(zip(T.DESCRIPTOR_NAMES, r.d))
        assert got["n_chars"] == len(r.t) and got["n_tokens"] == len(words)
        assert got["n_lines"] == r.t.count("\n") + 1
        assert got["distinct_token_ratio"] == pytest.approx(len(set(words)) / len(words))
        shares = [words.count(w) / len(words) for w in set(words)]
        assert got["token_entropy"] == pytest.approx(-sum(p * math.log2(p) for p in shares), abs=1e-12)


def test_feature_sets(spark):
    families = featurize.text_families(bits=8, patterns=("a",))
    assert featurize.available_sets(families) == list(featurize.FEATURE_SETS)
    few = [f for f in families if f.name in ("keys", "desc")]
    assert "chargram" not in featurize.available_sets(few) and "ngram_desc" in featurize.available_sets(few)
    assert [f.name for f in featurize.select_families(families, "keys_ngram")] == ["ngram", "keys"]
    with pytest.raises(ValueError):
        featurize.select_families(few, "chargram")


def test_assembly_agrees_with_cells_and_dense_arrays(spark):
    families = featurize.text_families(bits=16, patterns=("cat", "one"))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if tokens(t)], "row_id int, text string")
    docs = featurize.featurize(docs, families)
    vectors = {r.row_id: r.v for r in featurize.assemble(docs, families).select("row_id", vector_to_array("features").alias("v")).collect()}
    dense = {r.row_id: r["values"] for r in featurize.dense_array(docs, families).collect()}
    assert vectors == dense
    for r in featurize.sparse_cells(docs, families, ["row_id"]).collect():
        assert vectors[r.row_id][r.idx] == r.x


def cells_of(spark, matrix, y):
    data = [("d", int(t), j, float(v)) for row, t in zip(matrix, y) for j, v in enumerate(row) if v != 0]
    cells = spark.createDataFrame(data, "dataset string, target int, idx int, x double")
    labels = spark.createDataFrame([("d", int(t)) for t in y], "dataset string, target int")
    return cells, resample.class_distribution(labels)


def brute_f(column, y):
    groups = [[v for v, t in zip(column, y) if t == c] for c in (0, 1)]
    mean = sum(column) / len(column)
    between = sum(len(g) * (sum(g) / len(g) - mean) ** 2 for g in groups)
    within = sum((v - sum(g) / len(g)) ** 2 for g in groups for v in g)
    return between / (within / (len(column) - 2)) if within else 0.0


def brute_chi2(column, y):
    total, n, out = sum(column), len(column), 0.0
    for c in (0, 1):
        seen = sum(v for v, t in zip(column, y) if t == c)
        want = y.count(c) / n * total
        out += (seen - want) ** 2 / want if want else 0.0
    return out


@pytest.mark.parametrize("negative", [False, True])
def test_scores_match_brute_force(spark, negative):
    rng = random.Random(11)
    y = [int(rng.random() < 0.4) for _ in range(120)]
    matrix = [[rng.choice([0, 1]), t * rng.random() + rng.random() - (0.5 if negative else 0.0), 2.0, rng.choice([0, 0, 3])] for t in y]
    cells, classes = cells_of(spark, matrix, y)
    moments = score.class_moments(cells, classes)
    columns = list(zip(*matrix))
    got = {r.idx: r.score for r in score.anova_f(moments).collect()}
    for j, column in enumerate(columns):
        assert got[j] == pytest.approx(brute_f(column, y), rel=1e-9, abs=1e-9)
    if negative:
        columns = [[(v - min(c)) / (max(c) - min(c)) if max(c) > min(c) else 0.0 for v in c] for c in columns]
    got = {r.idx: r.score for r in score.chi2(moments).collect()}
    for j, column in enumerate(columns):
        assert got[j] == pytest.approx(brute_chi2(column, y), rel=1e-9, abs=1e-9)
    info = {r.idx: r.score for r in score.mutual_info_binned(cells, classes).collect()}
    n = len(y)
    want = 0.0
    for v in (0, 1):
        for c in (0, 1):
            p = sum(r[0] == v and t == c for r, t in zip(matrix, y)) / n
            px, py = sum(r[0] == v for r in matrix) / n, y.count(c) / n
            want += p * math.log(p / (px * py)) if p else 0.0
    assert info[0] == pytest.approx(want, abs=1e-12)
    assert info[2] == pytest.approx(0.0, abs=1e-12)


def test_top_k_beyond_width(spark):
    scores = spark.createDataFrame([("d", 0, 1.0), ("d", 1, 5.0), ("d", 2, 5.0)], "dataset string, idx int, score double")
    row = score.top_k(scores, ["dataset"], 50).first()
    assert row.K == 3 and row.features == [1, 2, 0]


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_neighbours_match_brute_force(spark, block_rows):
    rng = random.Random(3)
    points = [[rng.gauss(0, 1) + 6 * (i % 4) for _ in range(3)] for i in range(300)]
    points += [points[0]] * 40  # copies of one row
    train = spark.createDataFrame([(i, i % 2, p) for i, p in enumerate(points)], "row_id long, target int, values array<double>")
    asked = [[rng.gauss(0, 1) + 6 * (i % 4) for _ in range(3)] for i in range(50)] + [points[0]]
    queries = spark.createDataFrame([(i, p) for i, p in enumerate(asked)], "row_id long, values array<double>")
    found = {}
    for r in neighbors.k_nearest(train, queries, 7, pivots=8, block_rows=block_rows).collect():
        found.setdefault(r["query"], []).append((r.distance, r.neighbour))
    for i, q in enumerate(asked):
        want = sorted((math.dist(q, p), j) for j, p in enumerate(points))[:7]
        assert [j for _, j in sorted(found[i])] == [j for _, j in want]
    exact = {r.row_id: r.score for r in neighbors.knn_classify(train, queries, 7, pivots=8, block_rows=block_rows).collect()}
    same = sorted(j for j, p in enumerate(points) if p == points[0])[:7]
    assert exact[50] == pytest.approx(sum(j % 2 for j in same) / 7)


def test_naive_bayes_separates(spark):
    rng = random.Random(8)
    data = [("d", i, i % 2, [rng.gauss(3.0 * (i % 2), 1.0), 1.0]) for i in range(200)]
    rows = spark.createDataFrame(data, "dataset string, row_id int, target int, values array<double>")
    out = bayes.score(rows, bayes.fit(rows)).collect()
    assert sum(r.prediction == r.target for r in out) > 170
    assert all(0.0 <= r.score <= 1.0 for r in out)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_grams_are_hashed_in_batches_as_hash_slot_does(spark):
    texts = ["abc", "abcd", "żółw 木曜日 x", "a😀bc😀 d", "one two one two one two", "a\x0bb\u00a0c d", "\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", T.ngram_bits(F.col("t"), bits=100).alias("w"), T.chargram_bits(F.col("t"), bits=100).alias("c"))
    assert "md5" not in plan_of(rows)
    for r in rows.collect():
        words = tokens(r.t or "")
        if not words:
            assert r.w is None and r.c is None
            continue
        assert r.w == sorted({slot(" ".join(words[i : i + n]), 100) for n in (1, 2, 3) for i in range(len(words) - n + 1)})
        assert r.c == sorted({slot(r.t[i : i + 4], 100) for i in range(len(r.t) - 3)})


def test_texts_that_a_pattern_needs():
    assert T.needed("[Ll]oser") == (["Loser", "loser"], True) and T.needed(r"www\.") == (["www."], True)
    assert T.needed(r"(^|[ \n])[Uu]nd([ \n.,]|$)") == (["Und", "und"], False) and T.needed("https?://") == (["http"], False)
    for pattern in ("a|b", "[0-9]", "(?i)ab", r"\x41", r"\p{L}", "[^a]", "[a&&b]", "a?", "(ab)"):
        assert T.needed(pattern) == ([], False)


def test_patterns_by_needed_texts_find_what_a_regex_finds(spark):
    texts = ["und", "x Und.", "hund", "http:/", "see https://a", "www.a", "wwwxa", "a@b", "@ b", "<b", "< b", "{", "}", "8 €", "license", "", "The\r"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    every = [F.when(F.col("t").rlike(p), F.lit(i)) for i, p in enumerate(T.KEY_PATTERNS)]
    for r in df.select("t", T.key_bits(F.col("t")).alias("k"), F.array_compact(F.array(*every)).alias("e")).collect():
        assert r.k == (r.e if tokens(r.t) else None)


def test_sparse_vectors_are_made_without_structs_of_cells(spark):
    families = featurize.text_families(bits=16, patterns=("cat",))
    made = [(1, [5, 2], [0], [0.5, 0.0, 3.0], [1]), (2, [], [], [0.0], []), (3, [1], None, [1.0], [4])]
    df = spark.createDataFrame(made, "row_id int, ngram array<int>, keys array<int>, desc array<double>, chargram array<int>")
    vectors = df.select("row_id", featurize.sparse_vector(families).alias("v"))
    assert "named_struct(idx" not in plan_of(vectors)
    got = {r.row_id: (r.v.indices, r.v["values"]) for r in vectors.collect()}
    at = 17 + len(T.DESCRIPTOR_NAMES)
    assert got == {1: ([2, 5, 16, 17, 19, at + 1], [1.0, 1.0, 1.0, 0.5, 3.0, 1.0]), 2: ([], []), 3: (None, None)}


def test_cells_are_spread_out_without_an_array_of_them(spark):
    families = featurize.text_families(bits=16, patterns=("cat",))
    made = [(1, [2, 5], [0], [0.5, 0.0], [1]), (2, [3], None, [1.0, 2.0], [4]), (3, [], [], [None, 2.0], [])]
    df = spark.createDataFrame(made, "row_id int, ngram array<int>, keys array<int>, desc array<double>, chargram array<int>")
    cells = featurize.sparse_cells(df, families, ["row_id"])
    assert "named_struct" not in plan_of(cells)
    at = 17 + len(T.DESCRIPTOR_NAMES)
    want = [(1, 2, 1.0), (1, 5, 1.0), (1, 16, 1.0), (1, 17, 0.5), (1, 18, 0.0), (1, at + 1, 1.0), (3, 17, None), (3, 18, 2.0)]
    assert sorted(map(tuple, cells.collect()), key=lambda r: r[:2]) == want


def test_mutual_information_reads_cells_once(spark):
    cells, classes = cells_of(spark, [[1, 0.5], [0, 2.5], [1, 0]], [1, 0, 0])
    seen = spark.sparkContext.accumulator(0)

    def note(x):
        seen.add(1)
        return x

    noted = cells.withColumn("x", F.udf(note, "double").asNondeterministic()("x"))
    assert score.mutual_info_binned(noted, classes).count() == 2
    assert seen.value == cells.count()


def test_key_patterns_are_searched_as_java_does(spark):
    """All patterns of the dictionary run in Arrow batches, with the ends of lines that Java knows; others stay with Spark."""
    ends = ["", "\n", "\r", "\r\n", "\n\r", "\n\n", "\x85", "\u2028", "\u2029", "\x0b", ".", "\r.", "é"]
    texts = [f"{a}{w}{e}" for a in ("", "x ", "x\n", "x\r", "é") for w in ("the", "The", "und", "Le", "los", "le") for e in ends]
    texts += ["A1B", "AB", "1234 x", "a@b", "@", "<b", "< b", "https://", "http:/", '"', "'", "ä€", "x..", "\n\n x", " \n", "", None, "\U0001f600!", "\\"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    more = [r"[^a]", r"x.y", *T.KEY_PATTERNS]
    assert all(T._finder(p) for p in T.KEY_PATTERNS) and not any(T._finder(p) for p in more[:2])
    got = df.select("id", T.key_bits(F.col("text")).alias("a"), T._key_bits(F.col("text"), T.KEY_PATTERNS).alias("b"),
                    T.key_bits(F.col("text"), more).alias("c")).collect()
    assert [r for r in got if r.a != r.b] == []
    assert all([i - 2 for i in r.c if i > 1] == r.b for r in got if r.b is not None)


def test_descriptors_split_at_the_same_blanks_as_the_token_rule(spark):
    text = "a\x0bb \x1cc\xa0d\u2003e f\u3000\x85g\th"
    row = spark.createDataFrame([(text,), ("b a a\nc\rd\fe",)], "text string").select(T.descriptors(F.col("text")).alias("d")).collect()
    assert [r.d[T.DESCRIPTOR_NAMES.index("n_tokens")] for r in row] == [4.0, 6.0]
