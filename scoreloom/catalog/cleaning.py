"""Sources, sinks and row cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.catalog import common as C
from scoreloom.catalog import sql as S
from scoreloom.catalog.registry import query
from scoreloom.functions.numeric import clean_array, float32_or_zero, safe_score, threshold
from scoreloom.functions.text import DESCRIPTOR_NAMES
from scoreloom.operators import clean, featurize, metrics
from scoreloom.session import scratch_path
from scoreloom.sources import delimited, store
from scoreloom.sources.tables import labelled_vectors, table


@query(
    "csv_dialect_read",
    "SELECT ';' AS sep, o_orderkey AS key, o_totalprice AS price, o_orderpriority AS priority FROM orders"
    " UNION ALL SELECT ',', c_custkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_dialect_read(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    parts = []
    for df, sep in ((orders, ";"), (customers, ",")):
        path = scratch_path(spark, "delimited")
        df.toDF("key", "price", "priority").write.csv(path, sep=sep, header=True)
        back, found = delimited.read_delimited(spark, path)
        parts.append(
            back.select(
                F.lit(found).alias("sep"), F.col("key").cast("bigint"), F.col("price").cast("double"), "priority"
            )
        )
    return parts[0].unionByName(parts[1])


def _store(spark, sf):
    path = scratch_path(spark, "features")
    store.write_features(C.labelled(spark, sf, "keys", "desc"), path, C.family("keys", "desc"))
    return path


@query(
    "feature_store_read",
    S.ctes("docs", "keys", "wide")
    + "SELECT d.row_id, d.toxic AS target, coalesce(k.n, 0) AS n_keys, round(w.n_tokens, 6) AS n_tokens, round(w.token_entropy, 6) AS token_entropy"
    " FROM docs d JOIN wide w USING (row_id) LEFT JOIN (SELECT row_id, count(*) AS n FROM keys GROUP BY row_id) k USING (row_id)",
)
def feature_store_read(spark, sf):
    families = C.family("keys", "desc")
    rows = store.read_features(spark, _store(spark, sf), families, "keys_desc", dataset="toxic")
    return rows.filter(F.col("desc").isNotNull()).select(
        "row_id",
        "target",
        F.size("keys").cast("bigint").alias("n_keys"),
        F.round(F.get("desc", F.lit(DESCRIPTOR_NAMES.index("n_tokens"))), 6).alias("n_tokens"),
        F.round(F.get("desc", F.lit(DESCRIPTOR_NAMES.index("token_entropy"))), 6).alias("token_entropy"),
    )


_NAMES = ", ".join(f"'{n}'" for n in DESCRIPTOR_NAMES)


@query(
    "feature_manifest",
    S.ctes("keys", "wide")
    + "SELECT family, m.idx, feature, coalesce(s.rows_set, 0) AS rows_set FROM ("
    f"SELECT 'keys' AS family, CAST(i AS INTEGER) AS idx, 'keys_' || (i + 1) AS feature FROM range({S.N_KEYS}) r(i)"
    f" UNION ALL SELECT 'desc', CAST({S.N_KEYS} + i AS INTEGER), 'desc_' || ([{_NAMES}])[i + 1] FROM range({S.N_DESC}) r(i)) m"
    " LEFT JOIN (SELECT bit AS idx, count(*) AS rows_set FROM keys GROUP BY bit UNION ALL "
    + " UNION ALL ".join(
        f"SELECT {S.N_KEYS + i}, count(*) FILTER ({n} <> 0) FROM wide" for i, n in enumerate(DESCRIPTOR_NAMES)
    )
    + ") s ON s.idx = m.idx",
)
def feature_manifest(spark, sf):
    """Ordered feature names with the number of documents where the feature is not 0."""
    families = C.family("keys", "desc")
    docs = featurize.featurize(C.documents(spark, sf), families)
    seen = (
        featurize.sparse_cells(docs, families, ["row_id"])
        .filter(F.col("x") != 0)
        .groupBy("idx")
        .agg(F.count(F.lit(1)).alias("rows_set"))
    )
    return featurize.manifest(spark, families).join(seen, "idx", "left").select(
        "family", "idx", "feature", F.coalesce("rows_set", F.lit(0)).cast("bigint").alias("rows_set")
    )


@query(
    "feature_store_index",
    S.ctes("data")
    + f"SELECT dataset, count(*) AS \"Rows\", {S.N_KEYS + S.N_DESC + 3} AS \"Columns\", {S.N_KEYS + S.N_DESC} AS \"FeatureCount\","
    " count(*) FILTER (target = 0) AS \"Class0\", count(*) FILTER (target = 1) AS \"Class1\", false AS \"HasOptionalFamily\""
    " FROM data GROUP BY dataset",
)
def feature_store_index(spark, sf):
    families = C.family("keys", "desc")
    return store.store_index(store.read_features(spark, _store(spark, sf), families, "keys"), families)


_LINE_METRICS = (
    "WITH p AS (SELECT l_linestatus AS dataset, CAST(l_returnflag = 'R' AS INTEGER) AS target, 'quantity' AS experiment, l_quantity / 50.0 AS score FROM lineitem"
    " UNION ALL SELECT l_linestatus, CAST(l_returnflag = 'R' AS INTEGER), 'discount', l_discount / 0.1 FROM lineitem"
    " UNION ALL SELECT l_linestatus, CAST(l_returnflag = 'R' AS INTEGER), 'tax', l_tax / 0.08 FROM lineitem"
    " UNION ALL SELECT l_linestatus, CAST(l_returnflag = 'R' AS INTEGER), 'price', l_extendedprice / 100000.0 FROM lineitem),\n"
    "pred AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM p)"
)


@query(
    "source_report",
    "SELECT '03_feature_ablation' AS \"Step\", 'OK' AS \"Status\", 'orders.csv' AS \"SourceUsed\", count(*) AS \"Rows\" FROM orders"
    " UNION ALL SELECT '04_feature_selection', 'OK', 'customers', count(*) FROM customer"
    " UNION ALL SELECT '05_model_search', 'MISSING', 'nowhere.csv', 0",
)
def source_report(spark, sf):
    """An unreadable first choice, an empty first choice and a step with no source at all."""
    base = scratch_path(spark, "sources")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    orders.write.csv(f"{base}/orders.csv", sep=";", header=True)
    customers.filter("c_custkey < 0").write.parquet(f"{base}/empty")
    customers.write.parquet(f"{base}/customers")
    _, report = delimited.first_available(
        spark,
        {
            "03_feature_ablation": [f"{base}/absent.csv", f"{base}/orders.csv"],
            "04_feature_selection": [f"{base}/empty", f"{base}/customers"],
            "05_model_search": [f"{base}/nowhere.csv", f"{base}/nothing"],
        },
    )
    return report.withColumn("SourceUsed", F.substring_index("SourceUsed", "/", -1))


@query(
    "results_write_read",
    _LINE_METRICS + ",\n" + S.ladder("pred", "dataset, experiment") + ",\n" + S.metric_block("m", "ladder", "dataset, experiment")
    + f" SELECT dataset AS \"Dataset\", experiment, '05_model_search' AS step, {S.rounded('ROC', 'AP')}, NULL::DOUBLE AS F1 FROM m"
    f" UNION ALL SELECT dataset, experiment, '06_resampling', {S.rounded('ROC', 'AP', 'F1')} FROM m WHERE experiment = 'tax'",
)
def results_write_read(spark, sf):
    path = scratch_path(spark, "results")
    rows = metrics.metric_rows(C.line_scores(spark, sf, "quantity", "discount", "tax", "price"), ["dataset", "experiment"])
    rows = C.rounded(rows.select(F.col("dataset").alias("Dataset"), "experiment", "ROC", "AP", "F1"), "ROC", "AP", "F1")
    store.write_results(rows.drop("F1"), path, "05_model_search")
    store.write_results(rows.filter("experiment = 'tax'"), path, "06_resampling")
    return store.read_results(spark, path).select("Dataset", "experiment", "step", "ROC", "AP", "F1")


@query(
    "predictions_table",
    S.ctes("scored")
    + f"SELECT dataset, ([{_NAMES}])[view + 1] AS experiment, row_id, target, round(score, 6) AS score,"
    " CAST(score >= 0.5 AS INTEGER) AS prediction FROM scored WHERE split = 'test'",
)
def predictions_table(spark, sf):
    path = scratch_path(spark, "predictions")
    rows = C.with_prediction(C.univariate_scores(spark, sf).filter("split = 'test'"))
    store.write_predictions(
        rows.select("dataset", C.view_name(F.col("view")).alias("experiment"), "row_id", "target", "score", "prediction"), path
    )
    return C.rounded(spark.read.parquet(path), "score")


_RAW_SQL = (
    "CASE l_returnflag WHEN 'A' THEN CAST(l_discount * 10 AS VARCHAR) WHEN 'N' THEN l_linestatus || CAST(l_linenumber AS VARCHAR)"
    " ELSE ' ' || CAST(l_linenumber AS VARCHAR) || ' ' END"
)


@query(
    "target_coerce",
    f"SELECT l_returnflag, target, count(*) AS n FROM (SELECT l_returnflag, CAST(trunc(TRY_CAST(trim({_RAW_SQL}) AS DOUBLE)) AS INTEGER) AS target FROM lineitem)"
    " GROUP BY l_returnflag, target",
)
def target_coerce(spark, sf):
    raw = (
        F.when(F.col("l_returnflag") == "A", (F.col("l_discount") * 10).cast("string"))
        .when(F.col("l_returnflag") == "N", F.concat("l_linestatus", F.col("l_linenumber").cast("string")))
        .otherwise(F.concat(F.lit(" "), F.col("l_linenumber").cast("string"), F.lit(" ")))
    )
    rows = clean.coerce_target(table(spark, sf, "lineitem").withColumn("raw", raw), "raw")
    return rows.groupBy("l_returnflag", "target").agg(F.count(F.lit(1)).alias("n"))


@query(
    "usable_rows",
    "WITH r AS (SELECT d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),\n"
    "u AS (SELECT 'quality' AS dataset, text, quality AS target FROM r UNION ALL SELECT 'toxic', text, toxic FROM r)\n"
    "SELECT dataset, count(*) FILTER (target IS NOT NULL AND text IS NOT NULL) AS kept,"
    " count(*) FILTER (target IS NULL OR text IS NULL) AS dropped,"
    " count(*) FILTER (text IS NOT NULL AND target = 0) AS class0, count(*) FILTER (text IS NOT NULL AND target = 1) AS class1"
    " FROM u GROUP BY dataset",
)
def usable_rows(spark, sf):
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("row_id"), "quality", "toxic")
    docs = C.documents(spark, sf).join(labels, "row_id", "left")
    return clean.usable_report(C.by_target(docs))


@query(
    "family_alignment",
    "WITH v AS (SELECT len([x for x in regexp_split_to_array(html, '[ \\t\\n\\r\\f]+') if x <> '']) > 0 AS has, length(html) >= 2000 AS long FROM pages)\n"
    "SELECT a AS family_a, b AS family_b, count(*) FILTER (va AND vb) AS \"both\", count(*) FILTER (va AND NOT vb) AS only_a,"
    " count(*) FILTER (vb AND NOT va) AS only_b FROM ("
    "SELECT 'keys' AS a, 'desc' AS b, has AS va, has AS vb FROM v UNION ALL SELECT 'keys', 'long', has, long FROM v"
    " UNION ALL SELECT 'desc', 'long', has, long FROM v) GROUP BY a, b",
)
def family_alignment(spark, sf):
    """Two aligned text families of pages and one that rejects short pages."""
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("row_id"), F.col("html").alias("text"))
    rows = featurize.featurize(pages, C.family("keys", "desc")).withColumn(
        "long", F.when(F.char_length("text") >= 2000, F.array(F.char_length("text")))
    )
    return clean.alignment_report(rows, ["keys", "desc", "long"])


_SETS = [
    (name, featurize.select_families(C.FAMILIES, name)) for name in featurize.available_sets(C.FAMILIES)
]


@query(
    "family_select",
    S.ctes("docs", "doc_cells")
    + " UNION ALL ".join(
        f"SELECT '{name}' AS feature_set, {sum(f.size for f in fams)} AS feature_count,"
        " (SELECT count(*) FROM doc_cells c JOIN docs d USING (row_id) WHERE c.x <> 0 AND ("
        + " OR ".join(f"(c.idx >= {S.OFFSET[f.name]} AND c.idx < {S.OFFSET[f.name] + f.size})" for f in fams)
        + ")) AS cells"
        for name, fams in _SETS
    ),
)
def family_select(spark, sf):
    """Every feature set resolved to its families, with its non-zero cells over the labelled documents."""
    docs = C.labelled_documents(spark, sf).select("row_id", "text")
    counted = featurize.featurize(docs, C.FAMILIES).agg(
        *[
            F.sum(F.size(F.filter(f.name, lambda v: v != 0)) if f.kind == "dense" else F.size(f.name)).alias(f.name)
            for f in C.FAMILIES
        ]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("feature_set"),
                        F.lit(sum(f.size for f in fams)).alias("feature_count"),
                        sum((F.col(f.name) for f in fams), F.lit(0)).cast("bigint").alias("cells"),
                    )
                    for name, fams in _SETS
                ]
            )
        )
    )


@query(
    "matrix_clean",
    "WITH c AS (SELECT generate_subscripts(embedding, 1) - 1 AS idx, unnest(embedding)::DOUBLE AS x FROM embeddings)\n"
    "SELECT idx, count(*) AS cells, count(*) FILTER (x <= 0.2 AND x >= -0.2) AS kept,"
    " round(sum(CASE WHEN x <= 0.2 AND x >= -0.2 THEN x ELSE 0 END), 6) AS zero_sum FROM c GROUP BY idx",
)
def matrix_clean(spark, sf):
    """Vectors with NaN and infinite entries, cleaned to null and to 0."""
    broken = F.transform(
        "values",
        lambda v: F.when(v > 0.2, F.lit(float("inf"))).when(v < -0.2, F.lit(float("nan"))).otherwise(v),
    )
    rows = labelled_vectors(spark, sf).withColumn("values", broken)
    both = rows.select(
        F.posexplode(F.arrays_zip(clean_array(F.col("values"), "null").alias("n"), clean_array(F.col("values"), "zero").alias("z"))).alias("idx", "c")
    )
    return both.groupBy("idx").agg(
        F.count(F.lit(1)).alias("cells"), F.count("c.n").alias("kept"), F.round(F.sum("c.z"), 6).alias("zero_sum")
    )


@query(
    "descriptor_clean",
    "SELECT l_returnflag, count(*) FILTER (y = 0) AS zeros, round(sum(y / 1e38), 6) AS total FROM ("
    "SELECT l_returnflag, coalesce(CAST(TRY_CAST(l_extendedprice * 1e34 AS FLOAT) AS DOUBLE), 0.0) AS y FROM lineitem) GROUP BY l_returnflag",
)
def descriptor_clean(spark, sf):
    """Prices scaled past the 32-bit range: what overflows becomes 0."""
    rows = table(spark, sf, "lineitem").select("l_returnflag", float32_or_zero(F.col("l_extendedprice") * 1e34).alias("y"))
    return rows.groupBy("l_returnflag").agg(
        F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).alias("zeros"), F.round(F.sum(F.col("y") / 1e38), 6).alias("total")
    )


_VEC_SQL = (
    "vec AS (SELECT 'vectors' AS dataset, vec_id AS row_id, CAST(label < 3 AS INTEGER) AS target, embedding FROM embeddings),\n"
    "sizes AS (SELECT target, fl + CAST(row_number() OVER (ORDER BY rest DESC, target) <= test - fls AS BIGINT) AS take FROM ("
    "SELECT *, sum(fl) OVER () AS fls FROM (SELECT target, test, (n * test) // total AS fl, (n * test) % total AS rest FROM ("
    "SELECT target, n, total, CAST(ceil(total * 0.2::DOUBLE) AS BIGINT) AS test FROM ("
    "SELECT target, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM vec GROUP BY target))))),\n"
    "vsplit AS (SELECT v.*, CASE WHEN rn <= take THEN 'test' ELSE 'train' END AS split FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5('42:split:' || row_id), row_id) AS rn FROM vec) v JOIN sizes USING (target)),\n"
    "vcells AS (SELECT row_id, target, split, generate_subscripts(embedding, 1) - 1 AS idx, unnest(embedding)::DOUBLE AS x FROM vsplit)"
)


@query(
    "median_impute",
    f"WITH {_VEC_SQL},\n"
    "holes AS (SELECT row_id, split, idx, CASE WHEN abs(x) <= 0.2 AND idx <> 5 THEN x END AS x FROM vcells),\n"
    "med AS (SELECT idx, median(x) AS m FROM holes WHERE split = 'train' GROUP BY idx)\n"
    "SELECT row_id, split, count(*) AS width, round(sum(coalesce(x, m)), 6) AS total FROM holes JOIN med USING (idx) WHERE m IS NOT NULL GROUP BY row_id, split",
)
def median_impute(spark, sf):
    """Holes filled with training medians; one column has no training value and is dropped."""
    rows = C.split.stratified(labelled_vectors(spark, sf)).withColumn(
        "values", F.transform("values", lambda v, i: F.when((F.abs(v) <= 0.2) & (i != 5), v))
    )
    medians = clean.fit_median(rows.filter("split = 'train'"), "values")
    filled = clean.apply_median(rows, "values", medians)
    return filled.select(
        "row_id", "split", F.size("values").cast("bigint").alias("width"),
        F.round(F.aggregate("values", F.lit(0.0), lambda a, v: a + v), 6).alias("total"),
    )


@query(
    "score_sanitize",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 0.5 WHEN value > 40 THEN 1.0 WHEN value < 5 THEN 0.0 ELSE value / 100 END AS score FROM events",
)
def score_sanitize(spark, sf):
    raw = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("value") > 40, F.lit(float("inf")))
        .when(F.col("value") < 5, F.lit(float("-inf")))
        .otherwise(F.col("value") / 100)
    )
    return table(spark, sf, "events").select("event_id", safe_score(raw).alias("score"))


@query(
    "threshold_predict",
    "SELECT l_linestatus, l_discount, CAST(l_discount / 0.1 >= 0.5 AS INTEGER) AS prediction, count(*) AS n FROM lineitem GROUP BY ALL",
)
def threshold_predict(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("prediction", threshold(F.col("l_discount") / 0.1))
    return rows.groupBy("l_linestatus", "l_discount", "prediction").agg(F.count(F.lit(1)).alias("n"))


_WIDTH = sum(f.size for f in C.FAMILIES)


@query(
    "median_impute_sparse",
    S.ctes("split", "wide", "doc_cells")
    + f""", r AS (SELECT s.dataset, s.row_id FROM split s JOIN wide w ON w.row_id = s.row_id WHERE s.dataset <> 'events' AND s.split = 'train'),
    g AS (SELECT r.dataset, r.row_id, i.idx FROM r CROSS JOIN (SELECT unnest(range({_WIDTH})) AS idx) i),
    v AS (SELECT g.dataset, g.idx, CASE WHEN (g.row_id + g.idx) % 7 <> 0 THEN coalesce(c.x, 0.0) END AS x
          FROM g LEFT JOIN doc_cells c ON c.row_id = g.row_id AND c.idx = g.idx)
    SELECT dataset, idx::BIGINT AS idx, round(median(x), 6) AS median FROM v GROUP BY dataset, idx""",
)
def median_impute_sparse(spark, sf):
    """Training medians of all features of the four families, a seventh of the cells missing, bits never written out."""
    rows = C.split.stratified(C.labelled(spark, sf, *[f.name for f in C.FAMILIES]))
    rows = rows.filter((F.col("split") == "train") & F.col("desc").isNotNull())
    cells = featurize.sparse_cells(rows, C.FAMILIES, ["dataset", "row_id"])
    missing = (F.col("row_id") + F.col("idx")) % 7 == 0
    first = F.pmod(-F.col("row_id"), F.lit(7)).cast("int")
    holes = rows.select("dataset", "row_id", F.explode(F.sequence(first, F.lit(_WIDTH - 1), F.lit(7))).alias("idx"))
    cells = cells.filter(~missing).unionByName(holes.withColumn("x", F.lit(None).cast("double")))
    sizes = rows.groupBy("dataset").agg(F.count("*").alias("n"))
    medians = clean.sparse_median(cells.drop("row_id"), sizes)
    every = sizes.select("dataset", F.explode(F.sequence(F.lit(0), F.lit(_WIDTH - 1))).alias("idx"))
    out = every.join(medians.withColumn("stored", F.lit(True)), ["dataset", "idx"], "left")
    median = F.when(F.col("stored"), F.round("median", 6)).otherwise(0.0)
    return out.select("dataset", F.col("idx").cast("long").alias("idx"), median.alias("median"))


@query(
    "standardize",
    f"WITH {_VEC_SQL},\n"
    "c AS (SELECT row_id, split, idx, CASE WHEN idx = 7 THEN 1.0 ELSE x END AS x FROM vcells),\n"
    "mom AS (SELECT idx, avg(x) AS m, var_pop(x) AS v, min(x) AS lo, max(x) AS hi FROM c WHERE split = 'train' GROUP BY idx)\n"
    "SELECT row_id, split, count(*) AS width, round(sum((x - m) / sqrt(v)), 6) AS standard_sum, round(sum(abs((x - m) / sqrt(v))), 6) AS standard_abs,"
    " round(sum((x - lo) / (hi - lo)), 6) AS minmax_sum FROM c JOIN mom USING (idx) WHERE v > 0 GROUP BY row_id, split",
)
def standardize(spark, sf):
    """Train-fitted scaling of vectors; a constant column is filtered out."""
    rows = C.split.stratified(labelled_vectors(spark, sf)).withColumn(
        "values", F.transform("values", lambda v, i: F.when(i == 7, F.lit(1.0)).otherwise(v))
    )
    moments = clean.column_moments(rows.filter("split = 'train'"), "values")
    both = clean.rescale(rows.withColumn("unit", F.col("values")), "values", moments, "standard")
    both = clean.rescale(both, "unit", moments, "minmax")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    return both.select(
        "row_id", "split", F.size("values").cast("bigint").alias("width"),
        F.round(total(F.col("values")), 6).alias("standard_sum"),
        F.round(total(F.transform("values", lambda v: F.abs(v))), 6).alias("standard_abs"),
        F.round(total(F.col("unit")), 6).alias("minmax_sum"),
    )
