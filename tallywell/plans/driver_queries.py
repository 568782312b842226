"""Queries of the engine's operators over the driver's tables, with the SQL that checks each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.functions import values
from tallywell.operators import catalog, concat, diff, pivot, predicate, profile, report, sorting
from tallywell.operators.aggregate import Metric, aggregate
from tallywell.plans import dialect
from tallywell.sources import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES


def query(sql: str = ""):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = predicate.filtered(table(spark, sf_dir, "lineitem"), "l_quantity > 30 and l_returnflag = R or l_returnflag = N")
    return aggregate(items, ["l_returnflag", "l_linestatus"], [Metric("sum", "l_extendedprice"), Metric("avg", "l_quantity"), Metric("count")], top=10).df


# --- filters, projection, order


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_returnflag = 'R' OR l_quantity <= 2")
def filter_or_and(spark, sf_dir):
    return predicate.filtered(table(spark, sf_dir, "lineitem"), "l_quantity > 30 and l_returnflag = r or l_quantity <= 2").select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE upper(c_mktsegment) = 'BUILDING'")
def filter_text(spark, sf_dir):
    return predicate.filtered(table(spark, sf_dir, "customer"), "c_mktsegment = 'building'").select("c_custkey", "c_mktsegment")


@query("SELECT event_id, event_type FROM events WHERE event_type <> 'click' AND value IS NOT NULL")
def filter_not_equal(spark, sf_dir):
    return predicate.filtered(table(spark, sf_dir, "events"), "event_type != click", "value is not null").select("event_id", "event_type")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'")
def filter_days(spark, sf_dir):
    return predicate.filtered(table(spark, sf_dir, "orders"), "o_orderdate >= 1996-3-1 and o_orderdate <= 3/31/1996").select("o_orderkey")


@query("SELECT p_partkey, p_name FROM part WHERE lower(p_type) LIKE '%eco%' AND lower(p_name) NOT LIKE '%ring%'")
def filter_contains(spark, sf_dir):
    return predicate.filtered(table(spark, sf_dir, "part"), "p_type ~ Eco and p_name !~ RING").select("p_partkey", "p_name")


@query("SELECT c_name, c_acctbal FROM customer WHERE c_acctbal < 0")
def project_resolved(spark, sf_dir):
    from tallywell.functions.names import resolve_all

    df = predicate.filtered(table(spark, sf_dir, "customer"), "C_ACCTBAL < 0")
    return df.select(*resolve_all(["C_Name", "c acctbal"], df.columns))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20")
def sort_top(spark, sf_dir):
    return sorting.head(sorting.sort_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", order=["l_orderkey", "l_linenumber"]), 20)


@query("SELECT c_custkey, c_name FROM customer ORDER BY CAST(regexp_extract(c_name, '\\d+') AS BIGINT), c_custkey LIMIT 50")
def sort_natural(spark, sf_dir):
    return sorting.head(sorting.sort_rows(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name", order=["c_custkey"]), 50)


@query("SELECT n_name, n_regionkey FROM nation WHERE lower(n_name) LIKE '%ation_1%'")
def catalog_search(spark, sf_dir):
    return predicate.search(table(spark, sf_dir, "nation").select("n_name", "n_regionkey"), ["ation_1"], "n_name")


# --- aggregation with guards


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS sum_l_extendedprice,
    CAST(NULL AS VARCHAR) AS sum_l_extendedprice_na, CAST(sum(CAST(l_quantity AS DECIMAL(28,6))) AS DOUBLE) / count(l_quantity) AS avg_l_quantity,
    CAST(NULL AS VARCHAR) AS avg_l_quantity_na, count(*) AS count FROM lineitem GROUP BY ALL""")
def agg_by_two(spark, sf_dir):
    return aggregate(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], [Metric("sum", "l_extendedprice"), Metric("avg", "l_quantity"), Metric("count")]).df


@query("""SELECT event_type, min(value) AS min_value, max(value) AS max_value, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, count(props) AS count_props FROM events GROUP BY event_type""")
def agg_min_max(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("ts_text", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    out = aggregate(df, ["event_type"], [Metric("min", "value"), Metric("max", "value"), Metric("min", "ts_text"), Metric("count", "props")]).df
    return out.withColumnRenamed("min_ts_text", "first_ts")


@query("""SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) AS sum_o_totalprice, CAST(NULL AS VARCHAR) AS sum_o_totalprice_na, count(*) AS count FROM orders""")
def agg_totals(spark, sf_dir):
    return aggregate(table(spark, sf_dir, "orders"), ["o_orderstatus"], [Metric("sum", "o_totalprice"), Metric("count")]).totals


_MONEY = """SELECT n.n_name, c.c_mktsegment AS segment, CASE r.r_name WHEN 'EUROPE' THEN 'EUR' WHEN 'ASIA' THEN 'JPY' ELSE 'USD' END AS currency, c.c_acctbal AS amount
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""


def _money(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    currency = F.when(F.col("r_name") == "EUROPE", "EUR").when(F.col("r_name") == "ASIA", "JPY").otherwise("USD")
    return joined.select("n_name", F.col("c_mktsegment").alias("segment"), currency.alias("currency"), F.col("c_acctbal").alias("amount"))


@query(f"""SELECT segment, CASE WHEN count(DISTINCT currency) > 1 THEN NULL ELSE CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) END AS sum_amount,
    CASE WHEN count(DISTINCT currency) > 1 THEN 'n/a (' || count(DISTINCT currency) || ' currencies)' END AS sum_amount_na, max(amount) AS max_amount FROM ({_MONEY}) GROUP BY segment""")
def agg_mixed_currency(spark, sf_dir):
    return aggregate(_money(spark, sf_dir), ["segment"], [Metric("sum", "amount"), Metric("max", "amount")]).df


@query(f"""SELECT currency, CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE) AS sum_amount, CAST(NULL AS VARCHAR) AS sum_amount_na FROM ({_MONEY}) GROUP BY currency""")
def agg_by_currency(spark, sf_dir):
    return aggregate(_money(spark, sf_dir), ["currency"], [Metric("sum", "amount")]).df


@query(f"""SELECT CAST(NULL AS DOUBLE) AS sum_amount, 'n/a (' || count(DISTINCT currency) || ' currencies mixed in groups; add --by currency)' AS sum_amount_na FROM ({_MONEY})""")
def agg_mixed_total(spark, sf_dir):
    return aggregate(_money(spark, sf_dir), ["segment"], [Metric("sum", "amount")]).totals


@query("""SELECT c_mktsegment, CASE WHEN count(DISTINCT c_nationkey) > 1 AND count(*) > 1 THEN NULL ELSE CAST(sum(CAST(c_acctbal AS DECIMAL(28,6))) AS DOUBLE) END AS sum_amount,
    CASE WHEN count(DISTINCT c_nationkey) > 1 AND count(*) > 1 THEN 'n/a (' || count(DISTINCT c_nationkey) || ' subsidiaries)' END AS sum_amount_na FROM customer GROUP BY c_mktsegment""")
def agg_subsidiaries(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_mktsegment", F.col("c_nationkey").alias("subsidiary"), F.col("c_acctbal").alias("amount"))
    return aggregate(df, ["c_mktsegment"], [Metric("sum", "amount")]).df


@query("""SELECT c_mktsegment, CASE WHEN count(*) > 1 THEN NULL ELSE CAST(sum(CAST(c_acctbal AS DECIMAL(28,6))) AS DOUBLE) END AS sum_foreigntotal,
    CASE WHEN count(*) > 1 THEN 'n/a (currency unknown)' END AS sum_foreigntotal_na FROM customer GROUP BY c_mktsegment""")
def agg_currency_unknown(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_mktsegment", F.col("c_acctbal").alias("foreigntotal"))
    return aggregate(df, ["c_mktsegment"], [Metric("sum", "foreigntotal")]).df


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(F.col("o_orderkey").alias("transactionid"), "o_orderstatus", F.col("o_totalprice").alias("total"), F.col("l_extendedprice").alias("lineamount"))


@query("""SELECT o_orderstatus, CASE WHEN count(o_orderkey) > count(DISTINCT o_orderkey) THEN NULL ELSE CAST(sum(CAST(o_totalprice AS DECIMAL(28,6))) AS DOUBLE) END AS sum_total,
    CASE WHEN count(o_orderkey) > count(DISTINCT o_orderkey) THEN 'n/a (repeats per transactionid)' END AS sum_total_na,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS sum_lineamount, CAST(NULL AS VARCHAR) AS sum_lineamount_na
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus""")
def agg_header_repeat(spark, sf_dir):
    return aggregate(_lines(spark, sf_dir), ["o_orderstatus"], [Metric("sum", "total"), Metric("sum", "lineamount")]).df


@query("""SELECT l_returnflag, round(sum(CAST(l_discount AS DOUBLE) * 1e-8), 10) AS total, round(avg(CAST(l_discount AS DOUBLE) * 1e-8), 13) AS mean FROM lineitem GROUP BY 1""")
def agg_small_values(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_discount").cast("double") * 1e-8).alias("weight"))
    out = aggregate(df, ["l_returnflag"], [Metric("sum", "weight"), Metric("avg", "weight")]).df
    return out.select("l_returnflag", F.round("sum_weight", 10).alias("total"), F.round("avg_weight", 13).alias("mean"))


@query("SELECT c_mktsegment, min(c_name) AS min_c_name, max(c_name) AS max_c_name, count(*) AS count FROM customer GROUP BY 1")
def agg_text_min_max(spark, sf_dir):
    return aggregate(table(spark, sf_dir, "customer"), ["c_mktsegment"], [Metric("min", "c_name"), Metric("max", "c_name"), Metric("count")]).df


@query("SELECT o_custkey, count(*) AS count, max(o_totalprice) AS max_o_totalprice FROM orders GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 7")
def agg_top_groups(spark, sf_dir):
    return aggregate(table(spark, sf_dir, "orders"), ["o_custkey"], [Metric("count"), Metric("max", "o_totalprice")], sort="o_totalprice", top=7).df


@query("""SELECT p_brand, CAST(sum(CASE WHEN p_size % 5 <> 0 THEN p_size END) AS DOUBLE) AS sum_size, CAST(NULL AS VARCHAR) AS sum_size_na, 'sum_size: skipped ' || (SELECT count(*) FROM part WHERE p_size % 5 = 0) || ' values of size that are no numbers (such as "none").' AS note
    FROM part GROUP BY 1""")
def agg_typed_text(spark, sf_dir):
    from pyspark.sql import types as T

    size = F.when(F.col("p_size") % 5 == 0, "none").otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(".0")))
    df = table(spark, sf_dir, "part").select("p_brand", size.alias("size", metadata={"logical": "num"}))
    assert isinstance(df.schema["size"].dataType, T.StringType)
    made = aggregate(df, ["p_brand"], [Metric("sum", "size"), Metric("sum", "size")])
    return made.df.withColumn("note", F.lit("; ".join(made.warnings)))


@query("SELECT 'p_partkey' AS name, 'refused' AS outcome UNION ALL SELECT 'p_name', 'refused' UNION ALL SELECT 'exchange_rate', 'refused' UNION ALL SELECT 'p_size', 'allowed'")
def agg_refusals(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("exchange_rate", F.lit(1.5)).withColumnRenamed("p_partkey", "p_partid")
    out = []
    for c in ("p_partid", "p_name", "exchange_rate", "p_size"):
        try:
            aggregate(df, [], [Metric("sum", c)])
            out.append((c.replace("p_partid", "p_partkey"), "allowed"))
        except ValueError:
            out.append((c.replace("p_partid", "p_partkey"), "refused"))
    return spark.createDataFrame(out, "name string, outcome string")


# --- pivot


@query("""SELECT o_orderstatus, {0} FROM orders GROUP BY o_orderstatus""".format(", ".join(f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"))))
def pivot_count(spark, sf_dir):
    return pivot.pivot(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority").na.fill(0)


@query("""SELECT c_mktsegment AS segment, {0} FROM customer GROUP BY c_mktsegment""".format(", ".join(f"CAST(sum(CAST(p AS DECIMAL(28,6))) FILTER (WHERE flag = '{f}') AS DOUBLE) AS \"{f}\", CAST(NULL AS VARCHAR) AS \"{f}_na\"" for f in ("F", "O"))).replace("FROM customer GROUP BY c_mktsegment", "FROM (SELECT c_mktsegment, o_totalprice AS p, o_orderstatus AS flag FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus IN ('F', 'O')) GROUP BY c_mktsegment"))
def pivot_sum(spark, sf_dir):
    customer, orders = table(spark, sf_dir, "customer"), predicate.filtered(table(spark, sf_dir, "orders"), "o_orderstatus = F or o_orderstatus = O")
    df = customer.join(orders, customer.c_custkey == orders.o_custkey).select(F.col("c_mktsegment").alias("segment"), "o_orderstatus", "o_totalprice")
    return pivot.pivot(df, "segment", "o_orderstatus", Metric("sum", "o_totalprice"))


@query("""SELECT p_type, CAST(count(*) FILTER (WHERE k <= 12) AS BIGINT) AS shown, CAST(count(*) FILTER (WHERE k > 12) AS BIGINT) AS other
    FROM (SELECT p_type, dense_rank() OVER (ORDER BY p_size) AS k FROM (SELECT p_type, CAST(p_size AS VARCHAR) AS p_size FROM part)) GROUP BY p_type""")
def pivot_overflow(spark, sf_dir):
    wide = pivot.pivot(table(spark, sf_dir, "part"), "p_type", "p_size").na.fill(0)
    shown = [c for c in wide.columns[1:] if c != pivot.OTHER]
    total = sum((values.col(c) for c in shown[1:]), values.col(shown[0]))
    return wide.select("p_type", total.alias("shown"), values.col(pivot.OTHER).alias("other"))


@query(f"""SELECT n_name, {", ".join(f"CASE WHEN count(DISTINCT currency) FILTER (WHERE segment = '{m}') <= 1 THEN CAST(sum(CAST(amount AS DECIMAL(28,6))) FILTER (WHERE segment = '{m}') AS DOUBLE) END AS {m}, CASE WHEN count(DISTINCT currency) FILTER (WHERE segment = '{m}') > 1 THEN 'n/a (' || count(DISTINCT currency) FILTER (WHERE segment = '{m}') || ' currencies)' END AS {m}_na" for m in ("AUTOMOBILE", "BUILDING"))}
    FROM (SELECT CASE WHEN amount < 0 THEN 'debt' ELSE n_name END AS n_name, segment, currency, amount FROM ({_MONEY}) WHERE segment IN ('AUTOMOBILE', 'BUILDING')) GROUP BY n_name""")
def pivot_mixed_currency(spark, sf_dir):
    df = _money(spark, sf_dir).filter("segment in ('AUTOMOBILE', 'BUILDING')").withColumn("n_name", F.when(F.col("amount") < 0, "debt").otherwise(F.col("n_name")))
    return pivot.pivot(df, "n_name", "segment", Metric("sum", "amount"))


# --- diff, concatenation


_DIFF = """SELECT CAST(coalesce(a.k, b.k) AS VARCHAR) AS l_suppkey, a.v AS l_extendedprice_a, b.v AS l_extendedprice_b, b.v - a.v AS l_extendedprice_delta,
    CASE WHEN abs(a.v) >= 1 THEN floor((b.v - a.v) / abs(a.v) * 1000 + 0.5) / 10 END AS l_extendedprice_pct, CAST(NULL AS VARCHAR) AS l_extendedprice_na,
    CASE WHEN a.k IS NULL THEN 'only_b' WHEN b.k IS NULL THEN 'only_a' ELSE 'both' END AS _presence,
    CASE WHEN a.v IS NULL OR b.v IS NULL OR abs(b.v - a.v) > {tolerance} THEN 'changed' ELSE 'same' END AS _outcome
    FROM (SELECT l_suppkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS v FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) a
    FULL JOIN (SELECT l_suppkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS v FROM lineitem WHERE l_linenumber = 2 GROUP BY 1) b ON a.k = b.k"""


def _difference(spark: SparkSession, sf_dir: str, tolerance: float) -> diff.Difference:
    items = table(spark, sf_dir, "lineitem")
    return diff.diff(items.filter("l_linenumber = 1"), items.filter("l_linenumber = 2"), ["l_suppkey"], ["l_extendedprice"], tolerance)


@query(_DIFF.format(tolerance=0))
def diff_full_outer(spark, sf_dir):
    return _difference(spark, sf_dir, 0).df


@query(f"SELECT _outcome, count(*) AS count FROM ({_DIFF.format(tolerance=50000)}) GROUP BY _outcome")
def diff_tolerance(spark, sf_dir):
    return _difference(spark, sf_dir, 50000).df.groupBy("_outcome").count()


@query("""SELECT coalesce(a.k, b.k) AS code, a.v AS size_a, b.v AS size_b, CASE WHEN a.k IS NULL THEN 'only_b' WHEN b.k IS NULL THEN 'only_a' ELSE 'both' END AS _presence,
    CASE WHEN a.v IS NULL OR b.v IS NULL OR a.v <> b.v THEN 'changed' ELSE 'same' END AS _outcome
    FROM (SELECT CASE WHEN p_partkey % 4 = 0 THEN '00' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS k, CAST(p_size AS DOUBLE) AS v FROM part WHERE p_partkey % 3 < 2) a
    FULL JOIN (SELECT CASE WHEN p_partkey % 4 = 0 THEN '00' || p_partkey ELSE CAST(p_partkey AS VARCHAR) END AS k, CAST(p_size + (p_partkey % 5 = 0)::INT AS DOUBLE) AS v FROM part WHERE p_partkey % 3 > 0) b ON a.k = b.k""")
def diff_text_keys(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    zeros = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("00"), F.col("p_partkey").cast("string")))
    a = part.filter("p_partkey % 3 < 2").select(F.coalesce(zeros, F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(".50"))).alias("code"), F.col("p_size").alias("size"))
    a = a.withColumn("code", F.regexp_replace("code", r"\.50$", ".00"))
    b = part.filter("p_partkey % 3 > 0").select(F.coalesce(zeros, F.col("p_partkey").cast("string")).alias("code"), (F.col("p_size") + (F.col("p_partkey") % 5 == 0).cast("int")).alias("size"))
    return diff.diff(a, b, ["code"], ["size"]).df.select("code", "size_a", "size_b", "_presence", "_outcome")


@query("SELECT o_orderkey, o_totalprice, CAST(CASE WHEN o_orderpriority < '3' THEN 0 ELSE 1 END AS INTEGER) AS _page FROM orders")
def concat_pages(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_totalprice"]
    parts = [orders.filter("o_orderpriority >= '3'").select(*cols), orders.filter("o_orderpriority < '3'").select(*cols)]
    return concat.concat([concat.Page(parts[0], "select 1", index=1, size=500), concat.Page(parts[1], "select  1", index=0, size=500)]).df


@query("""SELECT o_orderkey, expected FROM (SELECT o_orderkey, lag(o_orderkey + n) OVER (ORDER BY o_orderkey) AS expected FROM (SELECT o_orderkey, 1 + o_custkey % 3 AS n FROM orders)) WHERE o_orderkey <> expected""")
def page_gaps(spark, sf_dir):
    return concat.gaps(table(spark, sf_dir, "orders").select("o_orderkey", (1 + F.col("o_custkey") % 3).alias("n")), "o_orderkey", "n")


# --- profile and ingest


@query("""SELECT 'c_custkey' AS name, 'num' AS type, 0::BIGINT AS nulls, count(DISTINCT c_custkey) AS "distinct" FROM customer
    UNION ALL SELECT 'c_name', 'str', 0, count(DISTINCT c_name) FROM customer UNION ALL SELECT 'c_nationkey', 'num', 0, count(DISTINCT c_nationkey) FROM customer
    UNION ALL SELECT 'c_acctbal', 'num', 0, count(DISTINCT c_acctbal) FROM customer UNION ALL SELECT 'c_mktsegment', 'str', 0, count(DISTINCT c_mktsegment) FROM customer""")
def profile_customer(spark, sf_dir):
    return profile.profile(table(spark, sf_dir, "customer")).select("name", "type", "nulls", "distinct")


@query("""SELECT name, v AS sum FROM (SELECT 'l_extendedprice' AS name, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS v FROM lineitem
    UNION ALL SELECT 'l_quantity', CAST(sum(CAST(l_quantity AS DECIMAL(28,6))) AS DOUBLE) FROM lineitem)""")
def profile_sums(spark, sf_dir):
    return profile.profile(table(spark, sf_dir, "lineitem").select("l_extendedprice", "l_quantity", "l_returnflag"), approximate=True).filter("sum is not null").select("name", "sum")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_flatten(spark, sf_dir):
    return ingest.parse_column(table(spark, sf_dir, "events").select("event_id", "props"), "props", "struct<k:bigint>")


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def date_normalised(spark, sf_dir):
    loose = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("day"))
    return ingest.normalise_dates(loose)


# --- reports


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report document for each market segment: regions as sections, their nations as lines, in cents."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    cents = F.sum(F.round(F.col("c_acctbal") * 100).cast("long"))
    nations = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey).groupBy("c_mktsegment", "r_name", "n_name").agg(cents.alias("v"))
    line = F.struct(F.col("n_name").alias("alias"), F.col("n_name").alias("value"), F.col("r_name").alias("parent"), F.array(F.struct(F.col("v").alias("Amount"))).alias("summaryLineValues"))
    head = nations.groupBy("c_mktsegment", "r_name").agg(F.sum("v").alias("v"), F.sort_array(F.collect_list(line)).alias("lines"))
    top = F.struct(F.col("r_name").alias("alias"), F.col("r_name").alias("value"), F.lit(None).cast("string").alias("parent"), F.array(F.struct(F.col("v").alias("Amount"))).alias("summaryLineValues"))
    entries = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct(F.col("r_name"), F.concat(F.array(top), F.col("lines")).alias("e")))), lambda x: x["e"]))
    columns = F.array(F.struct(F.lit("Amount").alias("id"), F.lit("Amount").alias("label"), F.lit("Amount").alias("path")))
    return head.groupBy("c_mktsegment").agg(entries.alias("entries")).select("c_mktsegment", F.to_json(F.struct(F.col("entries").alias("reportData"), columns.alias("reportColumns"))).alias("text"))


_NATIONS = """SELECT c_mktsegment AS id, r_name, n_name, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) AS v FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3"""


@query(f"""SELECT id, n_name AS line, 1 AS depth, 'line' AS kind, v AS "Amount" FROM ({_NATIONS}) UNION ALL SELECT id, r_name, 0, 'section', sum(v) FROM ({_NATIONS}) GROUP BY id, r_name""")
def report_flatten(spark, sf_dir):
    return report.flatten(_report(spark, sf_dir), "c_mktsegment", "text", ["Amount"]).select("id", "line", "depth", "kind", "Amount")


@query(f"""SELECT id, r_name AS line, sum(v) AS amount, CAST(count(*) AS BIGINT) AS n, CAST(CASE WHEN sum(v) = sum(v) THEN 1 END AS INTEGER) AS sign FROM ({_NATIONS}) GROUP BY id, r_name""")
def report_signs(spark, sf_dir):
    rows = report.flatten(_report(spark, sf_dir), "c_mktsegment", "text", ["Amount"])
    return report.section_signs(rows, "Amount").select("id", "line", "amount", "n", "sign")


@query("""SELECT id, ord, CASE WHEN ord % 17 = 0 THEN NULL ELSE ord - 1 END AS parent FROM (SELECT CAST(c_nationkey AS VARCHAR) AS id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS ord FROM customer)""")
def report_deep_parents(spark, sf_dir):
    from pyspark.sql import Window

    place = (F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1).cast("long")
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("id"), place.alias("ord")).withColumn("depth", (F.col("ord") % 17).cast("int"))
    return report.parents(rows).select("id", "ord", "parent")


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS id, CASE WHEN n_nationkey % 3 = 0 THEN 'error' ELSE 'section' END AS kind, CASE WHEN n_nationkey % 3 = 1 THEN CAST(n_nationkey AS DOUBLE) END AS amount FROM nation""")
def report_broken_documents(spark, sf_dir):
    cell = F.when(F.col("n_nationkey") % 3 == 1, F.col("n_nationkey").cast("string")).otherwise("no number")
    entry = F.struct(F.col("n_name").alias("alias"), F.col("n_name").alias("value"), F.array(F.struct(cell.alias("amount"))).alias("summaryLineValues"))
    whole = F.to_json(F.struct(F.array(entry).alias("reportData"), F.array(F.struct(F.lit("amount").alias("id"), F.lit("amount").alias("label"), F.lit("amount").alias("path"))).alias("reportColumns")))
    text = F.when(F.col("n_nationkey") % 3 == 0, F.substring(whole, 1, 30)).otherwise(whole)
    docs = table(spark, sf_dir, "nation").select("n_nationkey", text.alias("text"))
    return report.flatten(docs, "n_nationkey", "text", ["amount"]).select("id", "kind", "amount")


# --- the SQL dialect


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 1000 ORDER BY o_orderkey LIMIT 5")
def sql_fetch_first(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return dialect.run(spark, "SELECT o_orderkey FROM orders WHERE o_totalprice > 1000 ORDER BY o_orderkey FETCH FIRST 5 ROWS ONLY")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def sql_rownum(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return dialect.run(spark, "SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey) WHERE ROWNUM <= 10")


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' WHERE c_acctbal > 9000 GROUP BY c_custkey")
def sql_outer_plus(spark, sf_dir):
    _views(spark, sf_dir, "customer", "orders")
    return dialect.run(spark, "SELECT c.c_custkey, COUNT(o.o_orderkey) AS n FROM customer c, orders o WHERE c.c_custkey = o.o_custkey(+) AND o.o_orderstatus(+) = 'P' AND c.c_acctbal > 9000 GROUP BY c.c_custkey")


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n, sum(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END)::BIGINT AS done FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1""")
def sql_dates(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return dialect.run(spark, "SELECT TO_CHAR(o_orderdate, 'YYYY-MM') AS ym, COUNT(*) AS n, SUM(DECODE(o_orderstatus, 'F', 1, 0)) AS done FROM orders WHERE o_orderdate >= TO_DATE('1997-01-01', 'YYYY-MM-DD') GROUP BY TO_CHAR(o_orderdate, 'YYYY-MM')")


@query("SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 EXCEPT SELECT l_partkey FROM lineitem WHERE l_discount < 0.02")
def sql_minus(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return dialect.run(spark, "SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 MINUS SELECT l_partkey FROM lineitem WHERE l_discount < 0.02")


@query("""SELECT o_custkey AS entity, CAST(sum(CASE WHEN d <= 30 THEN 1 ELSE 0 END) AS BIGINT) AS d0_30, CAST(sum(CASE WHEN d > 30 AND d <= 90 THEN 1 ELSE 0 END) AS BIGINT) AS d31_90, CAST(sum(CASE WHEN d > 90 THEN 1 ELSE 0 END) AS BIGINT) AS d91
    FROM (SELECT o_custkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') AS d FROM orders WHERE o_orderstatus = 'O') GROUP BY 1""")
def sql_aging(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return dialect.run(spark, """SELECT o_custkey AS entity, SUM(CASE WHEN d <= 30 THEN 1 ELSE 0 END) AS d0_30, SUM(CASE WHEN d > 30 AND d <= 90 THEN 1 ELSE 0 END) AS d31_90, SUM(CASE WHEN d > 90 THEN 1 ELSE 0 END) AS d91
        FROM (SELECT o_custkey, datediff(TO_DATE('1998-08-02', 'YYYY-MM-DD'), TRUNC(o_orderdate)) AS d FROM orders WHERE o_orderstatus = 'O') GROUP BY o_custkey""")


@query("""SELECT a.k, a.n AS budget, coalesce(b.n, 0) AS actual FROM (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1) a LEFT JOIN (SELECT l_suppkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON a.k = b.k""")
def sql_two_sided(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return dialect.run(spark, """SELECT a.k, a.n AS budget, NVL(b.n, 0) AS actual FROM (SELECT l_suppkey AS k, COUNT(*) AS n FROM lineitem GROUP BY l_suppkey) a
        LEFT JOIN (SELECT l_suppkey AS k, COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey) b ON a.k = b.k""")


@query("SELECT l_orderkey, l_linenumber, trunc(l_extendedprice * 10) / 10 AS tenth, trunc(CAST(l_extendedprice AS DOUBLE)) AS whole, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS day FROM lineitem")
def sql_trunc(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return dialect.run(spark, "SELECT l_orderkey, l_linenumber, TRUNC(l_extendedprice, 1) AS tenth, TRUNC(l_extendedprice) AS whole, TO_CHAR(TRUNC(l_shipdate), 'YYYY-MM-DD') AS day FROM lineitem")


@query("SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') AS INTEGER) AS age FROM orders WHERE date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-02') > 400")
def sql_date_minus_date(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return dialect.run(spark, "SELECT o_orderkey, TO_DATE('1998-08-02', 'YYYY-MM-DD') - TRUNC(o_orderdate) AS age FROM orders WHERE TO_DATE('1998-08-02', 'YYYY-MM-DD') - TRUNC(o_orderdate) > 400")


@query("SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)")
def sql_with_over(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return dialect.run(spark, """WITH big AS (SELECT * FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice) FROM orders)) SELECT o_custkey, o_orderkey, CAST(RANK() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS "k" FROM big""")


@query("SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1 LIMIT 3")
def sql_top_unique(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return dialect.run(spark, "SELECT UNIQUE TOP 3 o_orderpriority FROM orders ORDER BY o_orderpriority")


@query("SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P') AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def sql_semi_anti(spark, sf_dir):
    _views(spark, sf_dir, "customer", "orders", "nation")
    return dialect.run(spark, "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P') AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")


# --- catalogue


@query("""SELECT n_name AS subsidiary, arg_min(seg, (-n, seg)) AS currency, max(n) / sum(n) AS share FROM (SELECT n_name, c_mktsegment AS seg, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) GROUP BY 1""")
def dominant_currency(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    df = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(F.col("n_name").alias("subsidiary"), F.col("c_mktsegment").alias("currency"), F.lit(1).alias("n"))
    return catalog.dominant_currency(df)


@query("""SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 1000000 THEN 5000 ELSE 25000 END AS DOUBLE) AS level FROM orders""")
def materiality(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", catalog.materiality(F.col("o_totalprice")).alias("level"))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN 'rate-limit' ELSE 'other' END AS class FROM events""")
def error_class(spark, sf_dir):
    message = F.when(F.col("event_type") == "error", "HTTP 429: too many requests").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", catalog.classify(message).alias("class"))


@query("""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2""")
def hourly_events(spark, sf_dir):
    from tallywell.streaming.pages import hourly

    return hourly(table(spark, sf_dir, "events")).withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH"))
