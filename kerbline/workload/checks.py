"""Queries that a wrong shuffle, split, classifier, neighbour search or scan would fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, learning
from ..operators.pivots import knn_by_pivots
from ..plans import recovery
from ..session import staging_path
from ..sources import drops, feeds, filelog, inputs
from ..sources.tables import path_exists, write_csv
from .base import R, case, table, text, tidy
from .cleaning import _FLAGS, _NAME_SQL, _ROUTE_SQL, _add_scan, _is_sql, _sound, feed_text, raw_feed
from .composites import PROFILE_CTE, profile
from .learning import _one_feature, embedding_vectors

# ---- shuffles, splits, classifiers ---------------------------------------------------


@case("m07_rows_apart", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS off FROM part")
def m07_apart(spark, sf):
    """Ways in which a shuffle is none: values that stay in their rows, or stay together."""
    names = ["p_size", "p_retailprice"]
    rows = table(spark, sf, "part").select("p_partkey", *names)
    out = learning.shuffle_columns(rows, names, key="p_partkey", seed=3)
    both = out.join(rows.select("p_partkey", *[F.col(c).alias(f"own_{c}") for c in names]), "p_partkey")
    price, size = F.col("p_retailprice"), F.col("p_size")
    # what chance leaves: shares of equal values, and of pairs that the table knows
    per = {c: rows.groupBy(c).agg(F.count(F.lit(1)).alias(f"n_{c}")) for c in names}
    known = rows.select(*names).distinct()
    alike = [per[c].agg((F.sum(F.col(f"n_{c}").cast("double") ** 2) / F.sum(f"n_{c}") ** 2)).first()[0] for c in reversed(names)]
    n = rows.count()
    pairs = known.join(per["p_size"], "p_size").join(per["p_retailprice"], "p_retailprice")
    met = pairs.agg(F.sum(F.col("n_p_size").cast("double") * F.col("n_p_retailprice"))).first()[0]
    chance = {"stay": alike[0], "stay_size": alike[1], "together": met / n**2 if n else None}
    found = both.join(known.withColumn("known", F.lit(True)), names, "left").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((price == F.col("own_p_retailprice")).cast("double")).alias("stay"),
        F.avg((size == F.col("own_p_size")).cast("double")).alias("stay_size"),
        F.avg(F.coalesce("known", F.lit(False)).cast("double")).alias("together"),
    )
    # six deviations, or a twelfth of the way from chance to rows that stay whole; where chance
    # alone leaves all as it is, nothing tells a shuffle
    most = {c: p + max((1 - p) / 12, 6 * (p * (1 - p) / n) ** 0.5) for c, p in chance.items() if p is not None}
    off = sum((F.col(c) > least).cast("long") for c, least in most.items()) if most else F.lit(0).cast("long")
    return found.select("n", off.alias("off"))


@case("m08_split_by_key", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS off FROM customer")
def m08_same(spark, sf):
    """Keys that another layout of the same rows splits otherwise, and fifths of the key
    order whose share in the test part is far from that of the whole."""
    rows = table(spark, sf, "customer").select("c_custkey")
    tests = [
        learning.split_rows(r, 0.33, key="c_custkey", seed=0)[1].withColumn(f"in_{i}", F.lit(1))
        for i, r in enumerate((rows, rows.repartition(7)))
    ]
    both = rows.join(tests[0], "c_custkey", "left").join(tests[1], "c_custkey", "left").fillna(0, ["in_0", "in_1"])
    fifths = learning.with_folds(both, 5, key="c_custkey").groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("in_0") != F.col("in_1")).cast("long")).alias("moved"),
        # six deviations of a share
        (F.abs(F.avg("in_0") - 0.33) > 6 * F.sqrt(0.33 * 0.67 / F.count(F.lit(1)))).cast("long").alias("uneven"),
    )
    return fifths.agg(F.sum("n").alias("n"), (F.sum("moved") + F.sum("uneven")).alias("off"))


@case(
    "m16_bayes_predictions",
    """WITH x AS (SELECT vec_id, label, j, CAST(embedding[j + 1] AS DOUBLE) AS v FROM embeddings, range(64) r(j)),
e AS (SELECT 1e-9 * max(s) AS eps FROM (SELECT var_pop(v) AS s FROM x GROUP BY j)),
m AS (SELECT label AS c, j, avg(v) AS mean, var_pop(v) + max(eps) AS var FROM x, e GROUP BY 1, 2),
p AS (SELECT label AS c, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM embeddings GROUP BY 1),
s AS (SELECT vec_id, m.c, sum(-0.5 * ln(2 * pi() * var) - (v - mean) * (v - mean) / (2 * var)) + max(prior) AS s
  FROM x JOIN m ON x.j = m.j JOIN p ON p.c = m.c GROUP BY 1, 2)
SELECT vec_id, arg_max(c, s) AS prediction FROM s GROUP BY 1""",
)
def m16_calls(spark, sf):
    rows = embedding_vectors(spark, sf).withColumn("label", F.col("label").cast("double"))
    model = learning.gaussian_bayes(learning.size_of(rows, "label"), {}).fit(rows)
    return model.transform(rows).select("vec_id", F.col("prediction").cast("int").alias("prediction"))


@case(
    "m20_nearest_by_pivots",
    """WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
d AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS r
  FROM v a CROSS JOIN v b WHERE a.vec_id % 5 = 0 AND b.vec_id % 5 <> 0),
c AS (SELECT vec_id, label, count(*) AS n FROM d WHERE r <= 5 GROUP BY 1, 2)
SELECT vec_id, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) AS r FROM c) WHERE r = 1""",
)
def m20_pivots(spark, sf):
    """A fifth of the rows called by the others: training and test rows are apart."""
    rows = table(spark, sf, "embeddings")
    test, train = rows.where("vec_id % 5 = 0"), rows.where("vec_id % 5 <> 0")
    return knn_by_pivots(test, train, 5, key="vec_id", vector="embedding", label="label")


@case(
    "d04_pairs_of_both_parts",
    f"""WITH x AS (SELECT o_custkey AS key, min(o_totalprice) / 1000 AS x, max(o_totalprice) / 1000 AS y FROM orders GROUP BY 1),
f AS (SELECT *, CASE WHEN ntile(4) OVER (ORDER BY key) = 4 THEN 'test' ELSE 'train' END AS part FROM x),
s AS (SELECT count(*) * covar_pop(y, x) / (count(*) * var_pop(x) + 300) AS b, avg(x) AS mx, avg(y) AS my FROM f WHERE part = 'train')
SELECT key, part, {R('y', 2)} AS actual, {R('my + b * (x - mx)', 3)} AS predicted,
  row_number() OVER (PARTITION BY part ORDER BY y, key) - 1 AS place FROM f, s""",
)
def d04_parts(spark, sf):
    """Actual beside predicted values of both parts, in the order of the actual ones."""
    parted = learning.with_folds(_one_feature(spark, sf), 4, key="key")
    train, test = parted.where("fold < 3"), parted.where("fold = 3")
    model = learning.ridge(learning.size_of(train, "label"), {"alpha": 300}).fit(train)
    out = None
    for part, rows in (("train", train), ("test", test)):
        pairs = model.transform(rows).select("key", "label", "prediction")
        ranked = evaluate.ordered_pairs(pairs, key="key", actual="label", predicted="prediction")
        shown = ranked.select(
            "key", F.lit(part).alias("part"), tidy("label", 2).alias("actual"), tidy("prediction", 3).alias("predicted"),
            F.col("rank").alias("place"),
        )
        out = shown if out is None else out.union(shown)
    return out


# ---- scans and loads -----------------------------------------------------------------


def _move(spark, source: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = b.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{source} could not be moved")


def staged_drop(spark, rows, root: str) -> None:
    """Stamped rows of a feed as one CSV file per file name, in the folder of its date."""
    where = f"{root}/parts"
    own = rows.drop("l_orderkey", "l_linenumber").withColumns(
        {"of_date": F.date_format("file_date", "dd_MM_yyyy"), "of_name": F.col("file_name")}
    )
    own.drop("file_date", "file_name").repartition("of_name").write.partitionBy("of_date", "of_name").option(
        "header", True
    ).csv(where)
    # one short path per file, that is per month
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(where)
    for row in parts.select("path").distinct().collect():
        date, name = (part.split("=", 1)[1] for part in row["path"].split("/")[-3:-1])
        _move(spark, row["path"], f"{root}/received/drop_{date}/files/{name}")


def _a_drop(spark, sf, route: str) -> str:
    root = staging_path(spark, f"drop-{route}")
    staged_drop(spark, _sound(raw_feed(spark, sf, route), route), root)
    return root


@case(
    "s01_files_of_a_drop",
    f"""SELECT DISTINCT {_NAME_SQL} AS file_name, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS file_date,
  {_ROUTE_SQL} AS route FROM lineitem WHERE {_is_sql(_FLAGS['lsoa_monthly'])} AND l_linenumber NOT IN (5, 7)
  AND l_discount > 0 AND l_tax > 0 AND l_tax <> 0.07""",
)
def s01(spark, sf):
    """The files of staged drops, by their listing."""
    found = drops.discover(spark, _a_drop(spark, sf, "lsoa_monthly"))
    return found.select("file_name", text("file_date").alias("file_date"), "route")


@case(
    "s06_tables_that_exist",
    f"""WITH n AS (SELECT count(*) AS n FROM lineitem WHERE {_is_sql(_FLAGS['msoa_daily'])})
SELECT t AS table_name, CAST(t = 'footfall_msoa_daily' AND n > 0 AS INTEGER) AS there FROM n, (VALUES {
    ', '.join(f"('{f.table}')" for f in feeds.FEEDS.values())}) AS x(t)""",
)
def s06(spark, sf):
    """Which of the six tables a load of one feed has made."""
    house = staging_path(spark, "house")
    feed = feeds.FEEDS["msoa_daily"]
    drops.load_rows(_sound(raw_feed(spark, sf, "msoa_daily"), "msoa_daily"), feed, f"{house}/{feed.table}")
    found = [(f.table, int(path_exists(spark, f"{house}/{f.table}"))) for f in feeds.FEEDS.values()]
    return spark.createDataFrame(found, "table_name string, there int")


@case(
    "s10_new_files_only",
    f"""WITH f AS (SELECT DISTINCT {_NAME_SQL} AS file_name FROM lineitem WHERE {_is_sql(_FLAGS['lsoa_monthly'])}
  AND l_linenumber NOT IN (5, 7) AND l_discount > 0 AND l_tax > 0 AND l_tax <> 0.07)
SELECT file_name, 1 AS load, 'append' AS action FROM f UNION ALL SELECT file_name, 2, 'unchanged' FROM f""",
)
def s10_new(spark, sf):
    """Two loads of the same drops: the first takes every file, the second opens none."""
    root = _a_drop(spark, sf, "lsoa_monthly")
    house = staging_path(spark, "house")
    out = None
    for load in (1, 2):
        done = filelog.load_new(spark, root, house).select("file_name", F.lit(load).alias("load"), "action")
        out = done if out is None else out.union(done)
    return out


_add_scan(
    "s11_yearly_spend_scan",
    "yearly_spend",
    f"""SELECT o_orderkey AS area_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS week_start,
  'area ' || o_custkey AS area_name, {R('o_totalprice', 2)} AS yoy_txn_amt_wd_retail, {R('o_totalprice / 7', 2)} AS yoy_txn_amt_we_retail,
  {R('CASE WHEN o_orderstatus = ' + "'O'" + ' THEN NULL ELSE o_totalprice END', 2)} AS yoy_txn_amt_wd_eating,
  {R('o_custkey', 2)} AS yoy_txn_amt_we_eating, {R('o_orderkey', 2)} AS yoy_txn_amt_wd_apparel, {R('0', 2)} AS yoy_txn_amt_we_apparel,
  {R('1', 2)} AS yoy_txn_cnt_wd_retail, {R('2', 2)} AS yoy_txn_cnt_we_retail FROM orders""",
    lambda spark, sf: table(spark, sf, "orders").select(
        F.lit(2).alias("yoy_txn_cnt_we_retail"), F.lit(1).alias("yoy_txn_cnt_wd_retail"), F.lit("x").alias("further"),
        F.lit(0).alias("yoy_txn_amt_we_apparel"), F.col("o_orderkey").alias("yoy_txn_amt_wd_apparel"),
        F.col("o_custkey").alias("yoy_txn_amt_we_eating"),
        F.when(F.col("o_orderstatus") == "O", F.lit("NaN")).otherwise(F.col("o_totalprice").cast("string")).alias("yoy_txn_amt_wd_eating"),
        (F.col("o_totalprice") / 7).alias("yoy_txn_amt_we_retail"), F.col("o_totalprice").alias("yoy_txn_amt_wd_retail"),
        F.concat(F.lit("area "), F.col("o_custkey").cast("string")).alias("area_name"),
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("week_start"),
        F.col("o_orderkey").alias("area_id"),
    ),
    lambda df: df.withColumn("week_start", text("week_start")).withColumns(
        {c: tidy(c, 2) for c in df.columns if c.startswith("yoy")}
    ),
)


@case(
    "s12_profile_scan",
    f"""WITH {PROFILE_CTE} SELECT c_custkey AS area_id, {R('n')} AS addresses, {R('total', 2)} AS population,
  {R('bottom / nullif(total, 0)', 6)} AS jsa, c_mktsegment AS class, CAST(c_nationkey AS VARCHAR) AS ptal,
  {R('ln(CASE WHEN total > 0 THEN total END)', 5)} AS log_population FROM customer JOIN pr ON c_custkey = o_custkey""",
)
def s12(spark, sf):
    """The exported profile, read by its declared columns and cleaned."""
    where = staging_path(spark, "profile") + ".csv"
    write_csv(profile(spark, sf), where)
    rows = inputs.read_profile(spark, where)
    cleaned = recovery.clean_profiles(rows).select(
        "area_id", F.col("`pct JSA 2021`").alias("jsa"), F.col("loac rank 1").alias("class"), "ptal",
        F.col("log_Pop").alias("lp"), F.col("num_addresses").alias("n"),
    )
    whole = rows.select("area_id", F.col("TotalPopulation").alias("total"))
    return cleaned.join(whole, "area_id").select(
        "area_id", tidy("n").alias("addresses"), tidy("total", 2).alias("population"), tidy("jsa", 6).alias("jsa"), "class",
        "ptal", tidy("lp", 5).alias("log_population"),
    )


@case(
    "v07_extended_schema",
    f"""WITH f AS (SELECT * FROM lineitem WHERE {_is_sql(_FLAGS['hex_daily'])})
SELECT 'l_orderkey:between' AS rule, count(*) FILTER (l_orderkey NOT BETWEEN 1 AND 20000) AS n FROM f
UNION ALL SELECT 'l_orderkey:not_null', count(*) FILTER (l_orderkey IS NULL) FROM f
UNION ALL SELECT 'l_orderkey:type', count(*) FILTER (FALSE) FROM f
UNION ALL SELECT 'time_indicator:between', count(*) FILTER (l_linenumber + 18 > 21) FROM f""",
)
def v07(spark, sf):
    """A feed's schema with a further column, and one of its columns with a tighter rule."""
    spec = feeds.extend(
        feeds.HEX_DAILY,
        l_orderkey=feeds.Field("bigint", between=(1, 20000)),
        time_indicator=feeds.Field("int", read="hour", between=(0, 21)),
    )
    report = feeds.violation_report(feed_text(table(spark, sf, "lineitem"), "hex_daily"), spec)
    return report.where(F.col("rule").startswith("l_orderkey") | (F.col("rule") == "time_indicator:between"))
