"""Joins, key rules, labels, predicates and set operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import predicates, scalar
from driftline.operators import relational as ops
from driftline.queries.registry import query, table


@query(
    """
    SELECT n_name, c_mktsegment, count(*) AS row_count
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2
    """
)
def dim_label_join(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    by_customer = ops.count_by_label(
        table(spark, sf, "orders"), customers, ["o_custkey"], ["c_nationkey", "c_mktsegment"]
    )
    named = ops.label_join(by_customer, nations, ["c_nationkey"], ["n_name"])
    return named.groupBy("n_name", "c_mktsegment").agg(F.sum("row_count").alias("row_count"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_filter(spark: SparkSession, sf: str) -> DataFrame:
    finished = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return ops.keep_matching(table(spark, sf, "customer").select("c_custkey", "c_name"), finished, ["c_custkey"])


@query(
    """
    SELECT p_partkey, p_name FROM part
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 40)
    """
)
def anti_filter(spark: SparkSession, sf: str) -> DataFrame:
    bulk = table(spark, sf, "lineitem").filter("l_quantity >= 40").select(F.col("l_partkey").alias("p_partkey"))
    return ops.keep_missing(table(spark, sf, "part").select("p_partkey", "p_name"), bulk, ["p_partkey"])


@query(
    """
    WITH sized AS (SELECT * FROM lineitem)
    SELECT l_orderkey, num, count(*) AS row_count
    FROM (SELECT l_orderkey, CAST(unnest(range(1, l_linenumber + 1)) AS INTEGER) AS num FROM sized)
    GROUP BY 1, 2
    """
)
def series_expand(spark: SparkSession, sf: str) -> DataFrame:
    rows = ops.expand_series(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), F.col("l_linenumber"))
    return rows.groupBy("l_orderkey", "num").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    WITH staged AS (
        SELECT l_partkey AS p_partkey, max(l_extendedprice) AS p_retailprice
        FROM lineitem WHERE l_quantity >= 45 GROUP BY 1
    )
    SELECT p.p_partkey, p.p_name, coalesce(s.p_retailprice, p.p_retailprice) AS p_retailprice
    FROM part p LEFT JOIN staged s USING (p_partkey)
    """
)
def update_from(spark: SparkSession, sf: str) -> DataFrame:
    staged = (
        table(spark, sf, "lineitem")
        .filter("l_quantity >= 45")
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(F.max("l_extendedprice").alias("p_retailprice"))
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    return ops.update_from(parts, staged, ["p_partkey"], ["p_retailprice"])


@query(
    """
    WITH target AS (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_acctbal < 0),
    ranked AS (
        SELECT o_custkey AS k, 'order ' || o_orderkey AS v,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
        FROM orders
    )
    SELECT k, v FROM target
    UNION ALL
    SELECT k, v FROM ranked WHERE rn = 1 AND k NOT IN (SELECT k FROM target)
    """
)
def upsert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    target = table(spark, sf, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("v")
    )
    candidates = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"),
        "o_orderkey",
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("v"),
    )
    return ops.insert_ignore(target, candidates, ["k"], ["o_orderkey"])


@query(
    """
    WITH e AS (SELECT l_orderkey AS k, CAST(max(l_linenumber) AS BIGINT) AS n FROM lineitem GROUP BY 1),
         a AS (SELECT o_orderkey AS k, count(l_orderkey) AS n
               FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag <> 'R' GROUP BY 1)
    SELECT coalesce(e.k, a.k) AS k, e.n AS expected_count, a.n AS actual_count,
           CASE WHEN coalesce(e.n, 0) <> coalesce(a.n, 0)
                THEN 'Rows inserted: ' || coalesce(a.n, 0) || ' (expected ' || coalesce(e.n, 0) || ')' END AS error_condition
    FROM e FULL OUTER JOIN a ON e.k = a.k
    """
)
def reconcile_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Largest line number per order against the order's lines that were not returned."""
    lines = table(spark, sf, "lineitem")
    expected = lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_linenumber").cast("long").alias("row_count"))
    kept = lines.filter("l_returnflag <> 'R'").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    actual = (
        table(spark, sf, "orders")
        .select(F.col("o_orderkey").alias("k"))
        .join(kept, "k", "left")
        .select("k", F.coalesce("n", F.lit(0)).alias("row_count"))
    )
    return ops.reconcile_counts(expected, actual, ["k"])


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """
)
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return ops.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT s_nationkey AS k FROM supplier UNION SELECT c_nationkey FROM customer")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k"))
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("k"))
    return ops.union_distinct(suppliers, customers)


@query(
    """
    SELECT source, count(*) AS row_count, round(sum(balance), 2) AS balance FROM (
        SELECT 'supplier' AS source, s_acctbal AS balance FROM supplier
        UNION ALL SELECT 'customer', c_acctbal FROM customer
    ) GROUP BY source
    """
)
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").select(F.lit("supplier").alias("source"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, sf, "customer").select(F.lit("customer").alias("source"), F.col("c_acctbal").alias("balance"))
    rows = ops.stack_rows(suppliers, customers)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("balance"), 2).alias("balance")
    )


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    ORDER BY o_orderdate, o_totalprice DESC, o_orderkey LIMIT 10
    """
)
def topk_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return ops.top_rows(orders, [F.asc("o_orderdate"), F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query(
    """
    WITH weights(o_orderpriority, weight) AS (
        VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2), ('5-LOW', 1)
    )
    SELECT o_custkey, CAST(sum(weight) AS BIGINT) AS weight FROM orders JOIN weights USING (o_orderpriority) GROUP BY 1
    """
)
def literal_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)]
    weights = ops.literal_rows(spark, rows, "o_orderpriority string, weight int")
    orders = table(spark, sf, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    # Five literal rows: broadcast.
    labelled = ops.label_join(orders, F.broadcast(weights), ["o_orderpriority"], ["weight"])
    return labelled.groupBy("o_custkey").agg(F.sum(F.col("weight") * F.col("n")).alias("weight"))


# --- labels and casts ------------------------------------------------------------


@query(
    """
    SELECT CASE WHEN x < 1 THEN 'Empty' WHEN x < 50 THEN 'Very Low (1-49)' WHEN x < 100 THEN 'Low (50-99)'
                WHEN x < 500 THEN 'Medium (100-499)' ELSE 'High (500+)' END AS band,
           count(*) AS row_count
    FROM (SELECT floor(o_totalprice / 750) AS x FROM orders) GROUP BY 1
    """
)
def value_bands(spark: SparkSession, sf: str) -> DataFrame:
    from driftline.operators.sketch import band_label

    scaled = table(spark, sf, "orders").select(F.floor(F.col("o_totalprice") / 750).alias("x"))
    return scaled.groupBy(band_label("x").alias("band")).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    SELECT CASE month(o_orderdate) WHEN 1 THEN 10 WHEN 2 THEN 27 WHEN 3 THEN 27 WHEN 4 THEN 53 ELSE 210 END AS size,
           CASE WHEN o_totalprice > 250000 THEN 'column' ELSE 'row' END AS orientation, count(*) AS row_count
    FROM orders GROUP BY 1, 2
    """
)
def case_labels(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    size = scalar.lookup(F.month("o_orderdate"), {1: 10, 2: 27, 3: 27, 4: 53}, 210)
    orientation = scalar.flag_label(F.col("o_totalprice") > 250000, "column", "row")
    return orders.groupBy(size.alias("size"), orientation.alias("orientation")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    """
    SELECT CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey AS VARCHAR) AS key_text,
           CAST(o_totalprice AS DECIMAL(10,2)) AS price, TRY_CAST(o_orderpriority AS INTEGER) AS bad_number,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank
    FROM orders
    """
)
def casts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("price"),
        F.col("o_orderpriority").try_cast("int").alias("bad_number"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("rank"),
    )


@query(
    r"""
    WITH s AS (SELECT o_orderkey, o_orderkey * 37 AS sec, CAST(o_totalprice * 100000 AS BIGINT) AS bytes FROM orders)
    SELECT o_orderkey,
           CASE WHEN sec // 86400 = 0 THEN '' WHEN sec // 86400 = 1 THEN '1 day, ' ELSE (sec // 86400) || ' days, ' END
           || printf('%d:%02d:%02d', sec % 86400 // 3600, sec % 3600 // 60, sec % 60) AS elapsed,
           CASE WHEN bytes < 10240 THEN bytes || ' bytes'
                WHEN bytes // 512 < 20479 THEN (bytes // 512 + 1) // 2 || ' kB'
                WHEN bytes // 524288 < 20479 THEN (bytes // 524288 + 1) // 2 || ' MB'
                ELSE (bytes // 536870912 + 1) // 2 || ' GB' END AS size
    FROM s
    """
)
def elapsed_and_size_text(spark: SparkSession, sf: str) -> DataFrame:
    size = (F.col("o_totalprice") * 100000).cast("decimal(20,0)").cast("long")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        scalar.clock_time(F.col("o_orderkey") * 37).alias("elapsed"),
        scalar.pretty_size(size).alias("size"),
    )


@query(
    r"""
    SELECT event_id, printf('%d.%06d', epoch_us(ts) // 1000000, epoch_us(ts) % 1000000) AS epoch, year(ts)::INTEGER AS year
    FROM events
    """
)
def epoch_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", scalar.epoch_text("ts").alias("epoch"), scalar.year_of("ts").alias("year")
    )


# --- predicates --------------------------------------------------------------------


@query(
    """
    SELECT event_type, count(*) AS row_count FROM events
    WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1
    """
)
def half_open_range(spark: SparkSession, sf: str) -> DataFrame:
    window = predicates.half_open("ts", datetime(2024, 1, 10), datetime(2024, 1, 20, 12))
    return table(spark, sf, "events").filter(window).groupBy("event_type").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
    WHERE l_suppkey = 7 AND l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 30
      AND l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1999-01-01'
    """
)
def point_and_range_lookup(spark: SparkSession, sf: str) -> DataFrame:
    wanted = predicates.matches_all(l_suppkey=7, l_returnflag=["A", "R"], l_quantity=(10.0, 30.0))
    dates = predicates.half_open("l_shipdate", datetime(1997, 1, 1), datetime(1999, 1, 1))
    return (
        table(spark, sf, "lineitem").filter(wanted & dates).select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    )


@query(
    """
    SELECT p_partkey, p_name, p_size FROM part
    WHERE list_has_all(string_split(p_name, ' '), ['red']) AND list_has_any(string_split(p_name, ' '), ['widget', 'ring'])
      AND p_size > 10 AND p_brand LIKE 'Brand#1%' AND p_type NOT LIKE 'ECO%'
    """
)
def array_and_text_filters(spark: SparkSession, sf: str) -> DataFrame:
    words = F.split("p_name", " ")
    return (
        table(spark, sf, "part")
        .filter(predicates.array_has_all(words, ["red"]) & predicates.array_has_any(words, ["widget", "ring"]))
        .filter((F.col("p_size") > 10) & predicates.text_prefix("p_brand", "Brand#1") & ~F.col("p_type").like("ECO%"))
        .select("p_partkey", "p_name", "p_size")
    )


@query(
    """
    SELECT event_id, user_id FROM events
    WHERE CAST(json_extract(props, '$.k') AS BIGINT) = 69 AND event_type NOT IN ('click', 'view')
      AND user_id IS NOT NULL AND value IS NOT NULL
    """
)
def json_contains_filter(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .filter(predicates.json_contains("props", {"k": 69}) & ~F.col("event_type").isin("click", "view"))
        .filter(predicates.both_present("user_id", "value"))
        .select("event_id", "user_id")
    )


@query("SELECT o_orderstatus, count(*) AS row_count FROM orders WHERE o_totalprice > 250000 GROUP BY 1")
def boolean_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Filter on a derived boolean column."""
    flagged = table(spark, sf, "orders").withColumn("is_active", F.col("o_totalprice") > 250000)
    return flagged.filter("is_active").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))
