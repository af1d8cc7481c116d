"""Registered queries: landed files round trips.

Each query lands data derived from the tables below the session's shared
checkpoint folder (a fresh sub-folder per call), then reads it back through
the bronze readers. The oracle is the original table content.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.nested import path
from ..session import scratch_path
from ..sources.landing import (incremental_load, load_pending, read_bronze, read_documents,
                               read_positional_csv, read_rejects, scan_positional_csv, write_landing)
from .documents import (FLATTEN_ARRAY_SQL, FLATTEN_NESTED_SQL, JSON_PATH_SQL, decode_orders, order_documents,
                        order_lines)
from .inputs import table
from .registry import query

RUN_TS = "2026-04-21 05:30:00"

# Regex patterns selecting the landed files of one feed.
ORDERS_DOCS = r".*/source=orders/dataset=documents/.*"
EVENTS_DOCS = r".*/source=events/dataset=stream/.*"


# Full microsecond precision; the JSON default keeps milliseconds only.
JSON_TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _events_json():
    return F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value", "props"), JSON_TS)


def decode_events(bronze):
    return bronze.select(
        path("raw", "$.event_id", "bigint").alias("event_id"),
        path("raw", "$.ts", "timestamp_ntz").alias("ts"),
        path("raw", "$.user_id", "bigint").alias("user_id"),
        path("raw", "$.event_type", "string").alias("event_type"),
        path("raw", "$.value", "double").alias("value"),
        path("raw", "$.props", "string").alias("props"))


@query("doc_roundtrip", FLATTEN_ARRAY_SQL, "S4 S5 S7 S8 J3")
def q_doc_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "landing")
    docs = order_documents(spark, sf_dir).select(
        F.lit("orders").alias("source"), F.lit("documents").alias("dataset"),
        F.date_format(F.trunc("doc_date", "month"), "yyyy-MM-dd").alias("ingest_date"), "value")
    write_landing(docs, root)
    # A second feed in the same landing root; the pattern keeps it out.
    ev = table(spark, sf_dir, "events").select(
        F.lit("events").alias("source"), F.lit("stream").alias("dataset"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"), _events_json().alias("value"))
    write_landing(ev, root)
    bronze = read_documents(spark, root, RUN_TS, pattern=ORDERS_DOCS)
    return decode_orders(bronze, parsed=True)


LANDING_SQL = """select event_id, ts, user_id, event_type,
  case when cast(ts as date) >= date '2024-01-15' then value * 2 else value end as value,
  props, cast(ts as date) as ingest_date
from events where cast(ts as date) >= date '2024-01-10'"""


@query("landing_roundtrip", LANDING_SQL, "S4 S5 S8")
def q_landing_roundtrip(spark, sf_dir):
    """Land every day, re-land the days from the 15th with revised values (a
    re-run replaces only its days), then read a date range: the partition
    filter prunes the listing."""
    root = scratch_path(spark, "landing")
    ev = table(spark, sf_dir, "events")

    def land(df):
        write_landing(df.select(F.lit("events").alias("source"), F.lit("stream").alias("dataset"),
                                F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"),
                                _events_json().alias("value")), root)

    land(ev)
    land(ev.filter(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
         .withColumn("value", F.col("value") * 2))
    b = read_documents(spark, root, RUN_TS, pattern=EVENTS_DOCS)
    b = b.filter(F.col("ingest_date") >= F.lit("2024-01-10").cast("date"))
    return decode_events(b).withColumn("ingest_date", F.col("ts").cast("date"))


def _wide_csv(spark, sf_dir, bad_dates: bool):
    """Orders as a wide 29-column CSV: key, date, value, a quoted title with a
    comma and the unit at positions 1, 5, 6, 25, 28."""
    o = table(spark, sf_dir, "orders")
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    if bad_dates:
        d = F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O"),
                   F.lit("not-a-date")).otherwise(d)
    cols = {i: F.lit(f"f{i}") for i in range(1, 30)}
    cols[1] = F.col("o_orderkey").cast("string")
    cols[2] = F.col("o_orderstatus")
    cols[5] = d
    cols[6] = F.when(F.col("o_orderstatus") != "P",
                     F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    cols[25] = F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(", "),
                        F.col("o_orderpriority"))
    cols[28] = F.lit("USD")
    header = ["KEY", "FREQ", "REF_AREA", "CURRENCY", "TIME_PERIOD", "OBS_VALUE"] + \
        [f"COL{i}" for i in range(7, 30)]
    return o.select(*[cols[i].alias(header[i - 1]) for i in range(1, 30)])


POSITIONS = {1: ("series_key", "string"), 5: ("obs_date", "date"),
             6: ("obs_value", "decimal(18,6)"), 25: ("title", "string"), 28: ("unit", "string")}

CSV_SQL = """select cast(o_orderkey as varchar) as series_key, cast(o_orderdate as date) as obs_date,
  case when o_orderstatus = 'P' then null
       else cast(cast(o_totalprice as decimal(18,2)) as decimal(18,6)) end as obs_value,
  'Order ' || cast(o_orderkey as varchar) || ', ' || o_orderpriority as title, 'USD' as unit
from orders"""


@query("csv_positional", CSV_SQL, "S6 S8 F2")
def q_csv_positional(spark, sf_dir):
    root = scratch_path(spark, "csv")
    _wide_csv(spark, sf_dir, False).write.option("header", True).csv(root)
    df = read_positional_csv(spark, root, 29, POSITIONS, RUN_TS, pattern=r".*\.csv$")
    return df.drop("_src_file", "_loaded_at")


LOAD_POLICY_SQL = f"""select x.* from ({CSV_SQL}) x
join orders o on cast(o.o_orderkey as varchar) = x.series_key
where not (o.o_orderpriority = '5-LOW' and o.o_orderstatus = 'O')"""


@query("load_policy", LOAD_POLICY_SQL, "S10 S6")
def q_load_policy(spark, sf_dir):
    """``continue`` policy: rows with an unparsable date are not loaded."""
    root = scratch_path(spark, "csv")
    _wide_csv(spark, sf_dir, True).write.option("header", True).csv(root)
    df = read_positional_csv(spark, root, 29, POSITIONS, RUN_TS, on_error="continue")
    return df.drop("_src_file", "_loaded_at")


INCREMENTAL_SQL = "select event_id, ts, user_id, event_type, value, props from events"


@query("incremental_load", INCREMENTAL_SQL, "S9 S10 S11 C1")
def q_incremental_load(spark, sf_dir):
    """Two landing rounds and three loads; the third finds nothing new. Every
    event must be in bronze exactly once."""
    land, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    ev = table(spark, sf_dir, "events")
    rounds = F.when(F.col("event_id") % 2 == 0, F.lit("2024-02-01")).otherwise(F.lit("2024-02-02"))
    tagged = ev.select(F.lit("events").alias("source"), F.lit("stream").alias("dataset"),
                       rounds.alias("ingest_date"), _events_json().alias("value"))
    write_landing(tagged.filter(F.col("ingest_date") == "2024-02-01"), land)
    incremental_load(spark, land, bronze, RUN_TS, pattern=EVENTS_DOCS)
    write_landing(tagged.filter(F.col("ingest_date") == "2024-02-02"), land)
    incremental_load(spark, land, bronze, RUN_TS, pattern=EVENTS_DOCS)
    incremental_load(spark, land, bronze, RUN_TS, pattern=EVENTS_DOCS)
    return decode_events(read_bronze(spark, bronze))


def _land_and_load(spark, docs):
    """Documents (``value``) landed by day and loaded: the path of their bronze table."""
    land, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    write_landing(docs, land, partition_cols=("ingest_date",))
    incremental_load(spark, land, bronze, RUN_TS)
    return bronze


@query("bronze_paths", JSON_PATH_SQL, "J1 J2 F2 S5 S9")
def q_bronze_paths(spark, sf_dir):
    """Typed paths into documents of a bronze table: two levels down, and a quoted
    key. The scan reads the shredded fields of these paths, not the documents."""
    ev = table(spark, sf_dir, "events")
    props = F.parse_json("props")
    doc = F.to_json(F.struct("event_id", F.struct(props.alias("props"), "user_id", "value").alias("body"), "event_type"))
    docs = read_bronze(spark, _land_and_load(spark, ev.select(
        F.date_format("ts", "yyyy-MM-dd").alias("ingest_date"), doc.alias("value"))))
    return docs.select(path("raw", "$.event_id", "bigint").alias("event_id"), path("raw", "$.body.props.k", "int").alias("k"),
                       path("raw", '$.body.props["k"]', "string").alias("k_text"))


@query("bronze_flatten", FLATTEN_NESTED_SQL, "J4 J1 S5 S9")
def q_bronze_flatten(spark, sf_dir):
    """The nested flatten from a bronze table of day documents: the scan reads the
    array of orders, not what stands beside it."""
    d = order_documents(spark, sf_dir)
    doc = F.concat(F.lit('{"block":'), F.col("doc_block").cast("string"), F.lit(',"source":'),
                   F.to_json(F.struct(F.lit("orders").alias("name"), F.col("doc_date").alias("day"))),
                   F.lit(',"orders":'), F.col("value"), F.lit("}"))
    bronze = _land_and_load(spark, d.select(F.date_format(F.trunc("doc_date", "month"), "yyyy-MM-dd").alias("ingest_date"),
                                            doc.alias("value")))
    return order_lines(read_bronze(spark, bronze), parsed=True, at="$.orders")


REJECTS_SQL = """select cast(o_orderkey as varchar) as series_key, 'bad value for obs_date: not-a-date' as reason
from orders where o_orderpriority = '5-LOW' and o_orderstatus = 'O'
union all select 'cut', 'wrong number of fields'"""


@query("load_rejects", REJECTS_SQL, "S10")
def q_load_rejects(spark, sf_dir):
    """Every record that ``continue`` does not load stands in the rejects table
    with its reason: unparsable dates, and a row cut short."""
    land, bronze = scratch_path(spark, "csv"), scratch_path(spark, "bronze")
    _wide_csv(spark, sf_dir, True).write.option("header", True).csv(f"{land}/d=1")
    spark.range(1).select(F.lit("header\ncut,short").alias("value")).coalesce(1).write.text(f"{land}/d=2")
    load_pending(spark, land, bronze, RUN_TS, pattern=r".*/part-[^/]*$", on_error="continue",
                 scan=lambda s, paths, ts: scan_positional_csv(s, paths, 29, POSITIONS, ts))
    return read_rejects(spark, bronze).select(
        F.substring_index("record", ",", 1).alias("series_key"), "reason")


@query("skip_file_retry", INCREMENTAL_SQL, "S9 S10")
def q_skip_file_retry(spark, sf_dir):
    """A file with a broken document is skipped whole and stays pending; once it
    is mended, the next load brings its rows, each event exactly once."""
    land, bronze = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    ev = table(spark, sf_dir, "events")
    day = F.when(F.col("event_id") % 2 == 0, F.lit("2024-02-01")).otherwise(F.lit("2024-02-02"))
    doc = _events_json()
    broken = F.when(F.col("event_id") % 2002 == 1, F.concat(F.lit("{"), doc)).otherwise(doc)
    tagged = ev.select(F.lit("events").alias("source"), F.lit("stream").alias("dataset"), day.alias("ingest_date"),
                       doc.alias("good"), broken.alias("bad"))
    write_landing(tagged.select("source", "dataset", "ingest_date", F.col("bad").alias("value")), land)
    load_pending(spark, land, bronze, RUN_TS, pattern=EVENTS_DOCS, on_error="skip_file")
    write_landing(tagged.filter("ingest_date = '2024-02-02'").select(
        "source", "dataset", "ingest_date", F.col("good").alias("value")), land)
    load_pending(spark, land, bronze, RUN_TS, pattern=EVENTS_DOCS, on_error="skip_file")
    return decode_events(read_bronze(spark, bronze))
