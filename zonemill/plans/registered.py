"""Every operator and job as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from zonemill.functions.clean import blank_to_null, conform, with_partition_month
from zonemill.functions.times import epoch_ms_to_date, run_stamp, run_time_text
from zonemill.layout import KEY_BUCKET, PARTITION_MONTH, RAW_ZONE
from zonemill.operators.compact import compact
from zonemill.operators.control import record_status, with_connection, work_list
from zonemill.operators.merge import latest_per_key, merge_upsert, missing_from_source
from zonemill.operators.window_delete import delete_window
from zonemill.plans.loads import extract_to_raw, run_work_list, zone_path
from zonemill.plans.purge import purge, purge_dataset, purge_list
from zonemill.plans.deliveries import TrustedTable, load_delivery, repartition_table
from zonemill.session import work_dir
from zonemill.sources import files
from zonemill.sources.datasets import (
    read_parquet,
    read_table,
    read_units,
    register_query_views,
    register_views,
    write_dataset,
)
from zonemill.streaming.ingest import ingest_stream, reject_empty

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The last load of the merge target, and the first day its next delivery covers.
LOADED_BEFORE = "2000-07-01"
DELIVERED_FROM = "1999-07-01"
AS_OF = "2001-08-01"


def query(function: Query) -> Query:
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = in_utc
    return in_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", glob="*")


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before the date, and those without one."""
    return table(spark, sf_dir, "orders").filter(~_from("o_orderdate", LOADED_BEFORE))


def _from(column: str, day: str) -> Column:
    """Whether a date is known and not before ``day``."""
    return F.coalesce(F.col(column) >= day, F.lit(False))


def delivered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= DELIVERED_FROM)
    return orders.withColumn("o_totalprice", F.col("o_totalprice") * 2)


def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One control row per nation; its region is the highway."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_regionkey").cast("string").alias("PartitionKey"),
        key.cast("string").alias("RowKey"),
        F.when(key % 3 == 0, "raw").when(key % 3 == 1, "trusted").otherwise("refined").alias("Zone"),
        F.when(key % 2 == 0, "1").otherwise("2").alias("JobStatus"),
        F.when(key % 4 == 0, "1").otherwise("0").alias("FlagFilter"),
        F.col("r_name").alias("highway"),
        F.col("n_name").alias("TableName"),
        F.lit("2001-07-01").alias("UpdatedDate"),
        F.lit(0).alias("JobExecution"),
    )


@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/nation.parquet", glob="*.parquet")


@query
def scan_partition_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "orders")
    write_dataset(table(spark, sf_dir, "orders"), path, partition_by="o_orderstatus")
    return read_parquet(spark, path, "o_orderstatus", "F", keep_partition_col=False)


@query
def scan_table_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "orders")
    orders = with_partition_month(table(spark, sf_dir, "orders"), "o_orderdate")
    write_dataset(orders, path, partition_by=PARTITION_MONTH)
    return read_table(spark, path, PARTITION_MONTH, "1998-10")


@query
def scan_by_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "customer")
    write_dataset(table(spark, sf_dir, "customer"), path, partition_by="c_mktsegment")
    return read_units(spark, f"{path}/c_mktsegment=%bu%", template=True)


@query
def append_with_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "customer")
    customer = table(spark, sf_dir, "customer")
    owing = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    write_dataset(customer.filter(owing).drop("c_mktsegment"), path)
    write_dataset(customer.filter(~owing), path)
    return read_table(spark, path, merge_schema=True)


@query
def blank_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blank_to_null(_with_blanks(table(spark, sf_dir, "orders")))


def _with_blanks(orders: DataFrame) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    return orders.withColumn("o_orderpriority", F.when(low, "").otherwise(F.col("o_orderpriority")))


@query
def partition_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = with_partition_month(table(spark, sf_dir, "orders"), "o_orderdate")
    return orders.groupBy(PARTITION_MONTH).agg(F.count(F.lit(1)).alias("orders"))


@query
def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = (
        "l_orderkey int, l_linenumber string, l_quantity int, l_discount decimal(4,2), "
        "l_returnflag varchar(1), l_shipdate date"
    )
    lineitem = table(spark, sf_dir, "lineitem")
    return conform(lineitem, schema, allow_truncation=True)


@query
def delete_window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_window(table(spark, sf_dir, "orders"), "o_orderdate", AS_OF)


@query
def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(loaded_orders(spark, sf_dir), delivered_orders(spark, sf_dir), ["O_ORDERKEY"])


@query
def merge_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and value per month after a cleaned delivery is merged."""
    target = with_partition_month(loaded_orders(spark, sf_dir), "o_orderdate")
    delivery = with_partition_month(blank_to_null(delivered_orders(spark, sf_dir)), "o_orderdate")
    merged = merge_upsert(target, delivery, ["o_orderkey"])
    return merged.groupBy(PARTITION_MONTH).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("value"),
    )


@query
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target keys are NULL where the delivery has '' or false, or NULL on both sides."""
    urgent, finished = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus") == "F"
    number = F.when(finished, F.lit(None)).otherwise(F.col("o_custkey")).alias("k_num")
    target = loaded_orders(spark, sf_dir).select(
        "o_orderkey",
        number,
        F.nullif("o_orderstatus", F.lit("P")).alias("k_str"),
        F.when(urgent, True).alias("k_bool"),
        "o_totalprice",
    )
    delivery = delivered_orders(spark, sf_dir).select(
        "o_orderkey",
        number,
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("k_str"),
        urgent.alias("k_bool"),
        "o_totalprice",
    )
    return merge_upsert(target, delivery, ["o_orderkey", "k_num", "k_str", "k_bool"])


def _with_audit(orders: DataFrame, inserted: str, updated: str) -> DataFrame:
    return orders.withColumns({"InsertedDate": F.lit(inserted), "UpdatedDate": F.lit(updated)})


@query
def merge_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _with_audit(loaded_orders(spark, sf_dir), "2001-01-01", "2001-01-02")
    delivery = _with_audit(delivered_orders(spark, sf_dir), "2001-08-01", "2001-08-02")
    return merge_upsert(target, delivery, ["o_orderkey"])


@query
def merge_audit_preserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _with_audit(loaded_orders(spark, sf_dir), "2001-01-01", "2001-01-02")
    delivery = _with_audit(delivered_orders(spark, sf_dir), "2001-08-01", "2001-08-02")
    return merge_upsert(target, delivery, ["o_orderkey"], audit="preserve")


@query
def merge_target_only_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = delivered_orders(spark, sf_dir).drop("o_orderpriority", "o_orderstatus")
    return merge_upsert(loaded_orders(spark, sf_dir), delivery, ["o_orderkey"])


@query
def merge_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = delivered_orders(spark, sf_dir).withColumn("channel", F.lower("o_orderpriority"))
    return merge_upsert(loaded_orders(spark, sf_dir), delivery, ["o_orderkey"], evolve=True)


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def merge_lineitem_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys on both sides: the delivery's latest row updates every target row."""
    lineitem = table(spark, sf_dir, "lineitem")
    target = lineitem.filter(~_from("l_shipdate", LOADED_BEFORE))
    delivery = lineitem.filter(F.col("l_shipdate") >= DELIVERED_FROM).withColumn("l_tax", F.col("l_tax") * 2)
    return merge_upsert(
        target, delivery, ["l_orderkey", "l_linenumber"], on_duplicate="latest", order_by=LINE_ORDER
    )


@query
def merge_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "orders")
    trusted = TrustedTable(path, ["o_orderkey"], "o_orderdate", partitioned=True)
    load_delivery(spark, _with_blanks(table(spark, sf_dir, "orders")), trusted)
    return read_table(spark, path)


@query
def merge_touched_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a table by month; the second moves its rows to a later month."""
    path = work_dir(spark, "orders")
    trusted = TrustedTable(path, ["o_orderkey"], "o_orderdate", partitioned=True)
    load_delivery(spark, loaded_orders(spark, sf_dir), trusted)
    later = F.col("o_orderdate") + F.expr("interval 40 days")
    load_delivery(spark, delivered_orders(spark, sf_dir).withColumn("o_orderdate", later), trusted)
    return read_table(spark, path)


@query
def merge_touched_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a table in buckets; the second delivers a few customers' orders again and some new ones."""
    path = work_dir(spark, "orders")
    trusted = TrustedTable(path, ["o_orderkey"], buckets=8)
    load_delivery(spark, loaded_orders(spark, sf_dir), trusted)
    load_delivery(spark, delivered_orders(spark, sf_dir), trusted)
    return read_table(spark, path).drop(KEY_BUCKET)


@query
def partition_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "orders")
    load_delivery(spark, table(spark, sf_dir, "orders"), TrustedTable(path, ["o_orderkey"]))
    repartition_table(spark, path, "o_orderdate")
    return read_table(spark, path)


@query
def merge_first_load_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first delivery with repeated keys gives the rows that a merge of it would."""
    path = work_dir(spark, "lineitem")
    options = {"on_duplicate": "latest", "order_by": LINE_ORDER}
    trusted = TrustedTable(path, ["l_orderkey", "l_linenumber"], merge_options=options)
    load_delivery(spark, table(spark, sf_dir, "lineitem"), trusted)
    return read_table(spark, path)


@query
def merge_after_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery adds a column; a later one without it touches the same months."""
    path = work_dir(spark, "orders")
    plain = TrustedTable(path, ["o_orderkey"], "o_orderdate", partitioned=True)
    wider = TrustedTable(path, ["o_orderkey"], "o_orderdate", partitioned=True, merge_options={"evolve": True})
    load_delivery(spark, loaded_orders(spark, sf_dir), plain)
    delivered = delivered_orders(spark, sf_dir)
    load_delivery(spark, delivered.withColumn("channel", F.lower("o_orderpriority")), wider)
    again = delivered.filter(F.col("o_orderkey") % 10 == 0)
    load_delivery(spark, again.withColumn("o_totalprice", F.col("o_totalprice") * 2), plain)
    return read_table(spark, path, merge_schema=True)


@query
def rewrite_mixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose later files have one column more, rewritten by month."""
    path = work_dir(spark, "orders")
    orders, late = table(spark, sf_dir, "orders"), _from("o_orderdate", LOADED_BEFORE)
    write_dataset(orders.filter(~late).drop("o_orderpriority"), path)
    write_dataset(orders.filter(late), path)
    repartition_table(spark, path, "o_orderdate")
    return read_table(spark, path, merge_schema=True)


@query
def scan_zero_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "customer")
    write_dataset(table(spark, sf_dir, "customer"), path, partition_by="c_nationkey")
    return read_parquet(spark, path, "c_nationkey", 0)


@query
def ingest_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every delivery that a run has merged and archived."""
    root = work_dir(spark, "lake")
    orders, late = table(spark, sf_dir, "orders"), _from("o_orderdate", LOADED_BEFORE)
    _land(orders.filter(~late), f"{root}/raw", "20220901000000001")
    _land(orders.filter(late), f"{root}/raw", "20220901000000002")
    _ingest(spark, root)
    archived = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/archive")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return archived.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("rows"))


@query
def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest order value replaces one column of the customers who ordered."""
    orders = table(spark, sf_dir, "orders").withColumn("c_custkey", F.col("o_custkey"))
    greatest = orders.groupBy("c_custkey").agg(
        F.max("o_totalprice").alias("c_acctbal"), F.max("o_orderstatus").alias("c_mktsegment")
    )
    customer = table(spark, sf_dir, "customer")
    return merge_upsert(customer, greatest, ["c_custkey"], columns=["c_acctbal"], audit="none")


@query
def missing_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= "2001-07-01")
    return missing_from_source(
        table(spark, sf_dir, "customer"), orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], prefilter=True
    )


@query
def compact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return compact(events.select("user_id", "event_type", F.to_date("ts").alias("updated")), "updated")


@query
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "ts", "value"
    )


@query
def work_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work_list(control_rows(spark, sf_dir), "raw", highway="AFRICA").unionByName(
        work_list(control_rows(spark, sf_dir), "refined")
    )


@query
def work_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    connections = table(spark, sf_dir, "region").select(
        F.col("r_name").alias("highway"),
        F.concat(F.lit("db-"), F.lower("r_name")).alias("Host"),
        (1500 + F.col("r_regionkey")).alias("Port"),
        F.lit("not carried").alias("Password"),
    )
    return with_connection(work_list(control_rows(spark, sf_dir)), connections, ["highway"])


@query
def work_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loads succeed and move their run date; trusted loads fail and keep it."""
    control = control_rows(spark, sf_dir)
    after = record_status(control, work_list(control, Zone="raw"), True, "2001-08-01")
    return record_status(after, work_list(control, Zone="trusted"), False, "2001-08-01")


def _landing_run(spark: SparkSession, sf_dir: str, run_date: str | None = "2001-08-01") -> str:
    """A run that lands the customers of each listed nation; Europe's source is down."""
    root = work_dir(spark, "lake")
    register_views(spark, {"zonemill_run_source": f"{sf_dir}/customer.parquet"})
    down = F.col("highway") == "EUROPE"
    control = control_rows(spark, sf_dir).withColumns(
        {
            "System": F.lit("erp"),
            "SchemaName": F.lit("sales"),
            "Query": F.when(down, "SELECT * FROM no_such_source").otherwise("SELECT * FROM zonemill_run_source"),
            "Filter": F.concat(F.lit(" WHERE c_nationkey = "), F.col("RowKey")),
        }
    )
    write_dataset(control, f"{root}/control")

    def land(row: Row) -> None:
        extract_to_raw(spark, row, root, spark.sql, "20220901172013123")

    run_work_list(spark, f"{root}/control", RAW_ZONE, land, run_date=run_date, log_path=f"{root}/log")
    return root


@query
def work_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a run: how each table ended, and whether it is dated today."""
    log = read_parquet(spark, f"{_landing_run(spark, sf_dir)}/log")
    today = F.substring("time", 1, 10) >= F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")
    return log.select("FilePath", "status", F.col("error").isNotNull().alias("failed"), today.alias("dated"))


@query
def work_run_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control table after a run without a given date: whether a row now bears today's."""
    after = read_parquet(spark, f"{_landing_run(spark, sf_dir, run_date=None)}/control")
    today = F.col("UpdatedDate") >= F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")
    return after.select("RowKey", "Zone", "JobExecution", today.alias("today"))


@query
def work_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control table after a run."""
    root = _landing_run(spark, sf_dir)
    landed = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/{RAW_ZONE}")
    customers = landed.groupBy(F.col("c_nationkey").cast("string").alias("RowKey")).agg(
        F.count(F.lit(1)).alias("landed")
    )
    after = read_parquet(spark, f"{root}/control").select("RowKey", "Zone", "UpdatedDate", "JobExecution")
    return after.join(customers, "RowKey", "left")


@query
def epoch_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return events.select("event_id", epoch_ms_to_date(F.col("ms")).alias("day"))


@query
def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = run_time_text(F.col("ts"), source_zone="UTC")
    return table(spark, sf_dir, "events").select("event_id", text.alias("run_time"), run_stamp(text).alias("stamp"))


@query
def extract_query_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control row's query and filter text, run by Spark as the source, landed and read."""
    register_views(spark, {"zonemill_extract_source": f"{sf_dir}/supplier.parquet"})
    row = {
        "Query": "SELECT s_suppkey, s_name, s_acctbal FROM zonemill_extract_source",
        "Filter": " WHERE s_acctbal > 0",
        "highway": "north",
        "System": "erp",
        "SchemaName": "sales",
        "TableName": "supplier",
    }
    root = work_dir(spark, "lake")
    schema = "s_suppkey int, s_name string, s_acctbal decimal(12,2)"
    extract_to_raw(spark, row, root, spark.sql, "20220901172013123", schema)
    return read_parquet(spark, zone_path(root, RAW_ZONE, row) + "/20220901172013123_supplier.parquet")


@query
def view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, {f"zonemill_{n}": f"{sf_dir}/{n}.parquet" for n in ("customer", "nation")})
    register_query_views(spark, {"zonemill_rich": "SELECT c_nationkey, c_acctbal FROM zonemill_customer WHERE c_acctbal > 5000"})
    return spark.sql(
        "SELECT n_name, count(*) AS customers, max(c_acctbal) AS best "
        "FROM zonemill_rich JOIN zonemill_nation ON c_nationkey = n_nationkey GROUP BY n_name"
    )


def _land(df: DataFrame, raw: str, stamp: str) -> None:
    write_dataset(df, f"{raw}/{stamp}_orders.parquet")


def _ingest(spark: SparkSession, root: str, as_of: str | None = None, combine: bool = False) -> str:
    path = f"{root}/trusted"
    trusted = TrustedTable(path, ["o_orderkey"], "o_orderdate", partitioned=True)
    ingest_stream(
        spark, f"{root}/raw", trusted, f"{root}/checkpoint", f"{root}/archive", f"{root}/failed", as_of, combine
    )
    return path


@query
def ingest_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping deliveries and an empty file; the second moves rows to other months."""
    root = work_dir(spark, "lake")
    orders = _with_blanks(table(spark, sf_dir, "orders"))
    day, price = F.col("o_orderdate"), F.col("o_totalprice")
    second = orders.filter((day >= "1997-01-01") & (day < "2000-07-01")).withColumns(
        {"o_totalprice": price * 2, "o_orderdate": day + F.expr("interval 40 days")}
    )
    third = orders.filter(day >= "2000-01-01").withColumn("o_totalprice", price * 3)
    _land(orders.filter(~_from("o_orderdate", "1998-01-01")), f"{root}/raw", "20220901000000001")
    files.write_text(spark, f"{root}/raw/20220901000000002_orders.parquet", "")
    _land(second, f"{root}/raw", "20220901000000003")
    path = _ingest(spark, root)
    _land(third, f"{root}/raw", "20220901000000004")
    _ingest(spark, root)
    return read_table(spark, path)


@query
def ingest_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four waiting deliveries, each with part of the one before again, in one merge."""
    root = work_dir(spark, "lake")
    orders = table(spark, sf_dir, "orders")
    of_year = F.year("o_orderdate")
    for year in (1995, 1997, 1999, 2001):
        since = F.lit(True) if year == 1995 else of_year >= year - 2
        until = F.lit(True) if year == 2001 else of_year <= year
        told = orders.filter((since & until) | ((year == 2001) & of_year.isNull()))
        _land(told.withColumn("told_in", F.lit(year)), f"{root}/raw", f"{year}0901000000001")
    return read_table(spark, _ingest(spark, root, combine=True))


@query
def ingest_mixed_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery of two files, of which one has a column more."""
    root = work_dir(spark, "lake")
    orders, late = table(spark, sf_dir, "orders"), _from("o_orderdate", LOADED_BEFORE)
    name = f"{root}/raw/20220901000000001_orders.parquet"
    write_dataset(orders.filter(~late).drop("o_orderpriority"), name)
    write_dataset(orders.filter(late), name)
    return read_table(spark, _ingest(spark, root))


@query
def ingest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run replaces the rows of the window before its reference date."""
    root = work_dir(spark, "lake")
    orders = table(spark, sf_dir, "orders")
    _land(orders, f"{root}/raw", "20220901000000001")
    _ingest(spark, root)
    open_again = orders.filter((F.col("o_orderdate") >= "2001-07-01") & (F.col("o_orderstatus") == "O"))
    _land(open_again.withColumn("o_totalprice", F.col("o_totalprice") * 2), f"{root}/raw", "20220902000000001")
    path = _ingest(spark, root, AS_OF)
    return read_table(spark, path)


@query
def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of what waits in raw, orders of odd years apart, with an empty file that is rejected."""
    root = work_dir(spark, "lake")
    orders, odd = table(spark, sf_dir, "orders"), F.coalesce(F.year("o_orderdate") % 2 == 1, F.lit(False))
    _land(orders.filter(odd), f"{root}/raw", "20220901000000001")
    _land(orders.filter(~odd), f"{root}/raw", "20220901000000002")
    files.write_text(spark, f"{root}/raw/20220901000000003_orders.parquet", "")
    rejected = reject_empty(spark, f"{root}/raw", f"{root}/failed").select("name", F.lit(True).alias("rejected"))
    kept = files.file_inventory(spark, f"{root}/raw").select("name", F.lit(False).alias("rejected"))
    landed = spark.read.option("recursiveFileLookup", True).parquet(f"{root}/raw")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    counts = landed.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    named = kept.unionByName(rejected).join(counts, "name", "left")
    return named.withColumn("rows", F.coalesce("rows", F.lit(0)))


@query
def dataset_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of the given order and line files."""
    sizes = [
        files.dataset_size(spark, f"{sf_dir}/{name}.parquet").withColumn("name", F.lit(name))
        for name in ("orders", "lineitem")
    ]
    return sizes[0].unionByName(sizes[1])


def _event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a user and type, known by the time of their last update in milliseconds."""
    time = F.unix_millis(F.col("ts").cast("timestamp")).alias("updated")
    return table(spark, sf_dir, "events").select("user_id", "event_type", time)


def _purged_events(spark: SparkSession, sf_dir: str, runs: int = 1) -> str:
    root = work_dir(spark, "lake")
    write_dataset(_event_history(spark, sf_dir), f"{root}/dims/users")
    listed = purge_list(spark, [("dims", "users", "users", "updated", "NT", "S")])
    for _ in range(runs):
        purge(spark, listed, lambda container, path: f"{root}/{container}/{path}", f"{root}/result")
    return root


@query
def purge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, f"{_purged_events(spark, sf_dir)}/dims/users")


@query
def purge_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run finds a date where the first one converted milliseconds."""
    return read_parquet(spark, f"{_purged_events(spark, sf_dir, runs=2)}/dims/users")


@query
def purge_mixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later file of the dataset has a column that the first lacks."""
    path = work_dir(spark, "users")
    events, late = _event_history(spark, sf_dir), F.coalesce(F.col("user_id") % 2 == 1, F.lit(False))
    write_dataset(events.filter(~late), path)
    write_dataset(events.filter(late).withColumn("kind", F.upper("event_type")), path)
    purge_dataset(spark, path, "updated", convert_date=True)
    return read_parquet(spark, path)


@query
def purge_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every listed dataset of a control file, and the rows left in it."""
    root = work_dir(spark, "lake")
    for name in ("users", "kept"):
        write_dataset(_event_history(spark, sf_dir), f"{root}/dims/{name}")
    lines = [
        "container;path;tb_name;update_column;table_type;convert_date",
        "dims;users;users;updated;NT;S",
        "dims;gone;gone;updated;NT;N",
        "dims; / ;skipped;updated;NT;N",
        "dims;kept;kept;updated;OT;S",
    ]
    files.write_text(spark, f"{root}/control.csv", "\n".join(lines) + "\n")
    listed = purge_list(spark, control_csv=f"{root}/control.csv")
    purge(spark, listed, lambda container, path: f"{root}/{container}/{path}", f"{root}/result")
    left = [
        read_parquet(spark, f"{root}/dims/{name}").agg(F.count(F.lit(1)).alias("rows_left")).withColumn("tb_name", F.lit(name))
        for name in ("users", "kept")
    ]
    audit = read_parquet(spark, f"{root}/result").select("tb_name", "status")
    return audit.join(left[0].unionByName(left[1]), "tb_name", "full")
