"""Inputs derived from the driver's tables; all numbers are synthetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.session import scratch_path
from muster.sinks.writers import write_csv
from muster.sources.lists import list_csv_files
from muster.sources.remote import home_folder, qualify, task_filesystem

ROWS_PER_PART = 1_000_000

MESSAGES = {
    "p02": "Your nurse line is open: reply 1 & ask",
    "ivr": "Call 100 for tips (free*)",
    "sms": "Reply 3 to chat ~ today",
}
SENDER = "15000"
CAMPAIGNS = [
    ("north", "north_pilot_SMS.csv", "Hello north", "15001"),
    ("north_again", "north_pilot_SMS.csv", "Hello again, north", "15001"),
    ("lake", "lake_IVR_trial.CSV", "Hello lake", "CARE LINE"),
    ("base", "plain_base.csv", "Hello all", "15002"),
]

SUBSCRIBERS = {
    "file_name": """case c_mktsegment when 'AUTOMOBILE' then 'north_pilot_SMS.csv'
        when 'BUILDING' then 'lake_IVR_trial.CSV' when 'FURNITURE' then 'p02_base_sms.csv'
        when 'HOUSEHOLD' then 'campaign_921465.csv' else 'plain_base.csv' end""",
    "row_key": "c_custkey",
    "msisdn_raw": """case c_custkey % 8
        when 0 then '  255' || lpad(cast(c_custkey as varchar(20)), 9, '0') || ' '
        when 2 then '+255' || lpad(cast(c_custkey as varchar(20)), 9, '0')
        when 3 then '255' || lpad(cast(c_custkey as varchar(20)), 8, '0')
        when 4 then '255' || lpad(cast(c_custkey as varchar(20)), 9, '0') || chr(13)
        when 5 then ''
        when 6 then '255' || lpad(cast(c_custkey % 50 as varchar(20)), 9, '0')
        when 7 then '255' || lpad(cast(c_custkey as varchar(20)), 9, '0') || chr(133)
        else '255' || lpad(cast(c_custkey as varchar(20)), 9, '0') end""",
    "age_raw": """case c_custkey % 11 when 0 then '' when 1 then 'abc' when 2 then '35.7' when 3 then ' 40'
        when 4 then '40d' when 5 then '3.5e1' when 6 then null else cast(c_custkey % 80 as varchar(20)) end""",
}

TRAFFIC = {
    "row_key": "event_id",
    "msisdn": "'255' || lpad(cast(user_id as varchar(20)), 9, '0')",
    "transport_errno": "case when event_type = 'error' then 28 else 0 end",
    "ts": "ts",
}

# List files of 100 customers, more where the table is large, so that there are about a
# thousand of them and none has over a million rows: name, and what is wrong with some.
LISTS = {
    "list_rows": "least(1000000, greatest(100, cast(floor(count(*) / 1000) as bigint)))",
    "list_no": "cast(floor(c_custkey / {list_rows}) as bigint)",
    "marker": """case list_no % 6 when 0 then 'SMS' when 1 then 'Ivr' when 2 then 'p02'
        when 3 then '921465_sms' when 4 then 'other' else 'sms_ivr' end""",
    "ext": "case list_no % 5 when 2 then 'CSV' when 4 then 'txt' else 'csv' end",
    "list_name": "'list_' || lpad(cast(list_no as varchar(20)), 9, '0') || '_' || marker || '.' || ext",
    "list_state": """case list_no % 7 when 2 then 'missing' when 3 then 'empty' when 4 then 'no_key_column'
        when 5 then 'swapped' when 6 then 'unopenable' else 'plain' end""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.expr(rule).alias(name) for name, rule in SUBSCRIBERS.items()]
    return table(spark, sf_dir, "customer").select(*columns)


def traffic(spark: SparkSession, sf_dir: str, files: int = 1) -> DataFrame:
    """Requests with their outcome, spread over ``files`` lists by user."""
    columns = [F.expr(rule).alias(name) for name, rule in TRAFFIC.items()]
    name = F.concat(F.lit("traffic_"), (F.col("user_id") % files).cast("string"), F.lit(".csv"))
    return table(spark, sf_dir, "events").select(name.alias("file_name"), *columns)


def with_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the list they are in: ``list_no``, ``list_name``, ``list_state``."""
    customers = table(spark, sf_dir, "customer")
    list_rows = customers.select(F.expr(LISTS["list_rows"])).first()[0]
    rows = customers.withColumn("list_no", F.expr(LISTS["list_no"].format(list_rows=list_rows)))
    for name in ("marker", "ext", "list_name", "list_state"):
        rows = rows.withColumn(name, F.expr(LISTS[name]))
    return rows


def list_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_list(spark, sf_dir).select("list_no", "list_name", "list_state").distinct()


_written: dict[tuple, object] = {}


def list_folder(spark: SparkSession, sf_dir: str, label: str = "lists") -> tuple[str, list[str]]:
    """A folder with the lists as files, and the paths of all lists, also those never written."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        folder = qualify(scratch_path(spark, label), home_folder(spark))
        cells = [F.expr(SUBSCRIBERS[name]).alias(name) for name in ("row_key", "msisdn_raw", "age_raw")]
        rows = with_list(spark, sf_dir).select("list_no", "list_name", "list_state", *cells)
        # A file is one run of bytes, so one task writes it; list_rows bounds its size.
        names = rows.groupBy("list_no").applyInPandas(_list_writer(folder), "list_no long, list_name string")
        _written[key] = (folder, [f"{folder}/{r.list_name}" for r in names.orderBy("list_no").collect()])
    return _written[key]


def _list_writer(folder):
    locate = task_filesystem()

    def write_list(rows):
        import csv
        import io

        first = rows.iloc[0]
        state = first["list_state"]
        header = ("msisdn" if state == "no_key_column" else "MSISDN", "AGE")
        columns = ("msisdn_raw", "age_raw")
        if state == "swapped":
            header, columns = header[::-1], columns[::-1]
        text = io.StringIO()
        if state != "empty":
            out = csv.writer(text, lineterminator="\n")
            out.writerow(header)
            ordered = rows.sort_values("row_key")
            out.writerows(zip(*(ordered[name] for name in columns)))
        filesystem, inner = locate(f"{folder}/{first['list_name']}")
        if state == "unopenable":
            filesystem.create_dir(inner, recursive=True)
        elif state != "missing":
            filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            with filesystem.open_output_stream(inner, compression=None) as stream:
                stream.write(text.getvalue().encode())
        return rows[["list_no", "list_name"]].head(1)

    return write_list


def spelled(folder: str, paths: list[str]) -> list[str]:
    """The same files, named in other ways."""
    ways = ("", "/", "/.", "/x/..", "/./x//..")
    return [f"{folder}{ways[i % len(ways)]}{path[len(folder) :]}" for i, path in enumerate(paths)]


def campaign_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One campaign for every list, and two more for every third."""
    names = list_names(spark, sf_dir).select("list_name", "list_no")
    every = F.array(F.lit("all"))
    third = F.array(*[F.lit(c) for c in ("all", "again", "third")])
    campaigns = names.withColumn("campaign", F.explode(F.when(F.col("list_no") % 3 == 0, third).otherwise(every)))
    return campaigns.select(
        "campaign",
        F.col("list_name").alias("file_name"),
        F.concat(F.lit("Hello from "), "campaign").alias("message"),
        F.lit(SENDER).alias("sender"),
    )


def quoted_lists(spark: SparkSession, sf_dir: str) -> list[str]:
    """The subscribers as CSV parts with a name of two lines before the number."""
    key = (spark.sparkContext.applicationId, sf_dir, "quoted")
    if key not in _written:
        rows = subscribers(spark, sf_dir).select(
            F.concat(F.lit('The "first"\nor, line '), "row_key").alias("NAME"), F.col("msisdn_raw").alias("MSISDN"), "row_key"
        )
        folder = scratch_path(spark, "quoted")
        parts = max(4, -(-rows.count() // ROWS_PER_PART))
        write_csv(rows.repartitionByRange(parts, "row_key").sortWithinPartitions("row_key").drop("row_key"), folder)
        _written[key] = list_csv_files(spark, folder)
    return _written[key]


def bulk_lists(spark: SparkSession, sf_dir: str, name: str) -> list[str]:
    """A whole fixture as CSV parts whose order by name is the order by ``ROW_KEY``."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        if name == "subscribers":
            rows = subscribers(spark, sf_dir).select(
                F.col("msisdn_raw").alias("MSISDN"), F.col("age_raw").alias("AGE"), F.col("row_key").alias("ROW_KEY")
            )
        else:
            rows = traffic(spark, sf_dir).select(
                F.col("msisdn").alias("MSISDN"),
                F.col("transport_errno").cast("string").alias("ERRNO"),
                F.col("row_key").alias("ROW_KEY"),
            )
        folder = scratch_path(spark, name)
        parts = max(4, -(-rows.count() // ROWS_PER_PART))
        write_csv(rows.repartitionByRange(parts, "ROW_KEY").sortWithinPartitions("ROW_KEY"), folder)
        _written[key] = list_csv_files(spark, folder)
    return _written[key]
