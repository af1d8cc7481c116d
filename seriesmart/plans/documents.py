"""Registered queries: nested documents built from the tables, then decoded.

The documents are derived from ``orders``/``lineitem``/``events`` so their
volume grows with the tables. A document never holds more than ``BLOCK``
orders (one order-key block of one day) and an order at most its own line
items: no group is unbounded. Junk values are injected by data-driven rules
(status, priority), never by dropping rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import month_start
from ..operators.nested import (decode_jsonstat, drop_null_observations, fields, flatten,
                                parse_documents, path, zip_arrays)
from .inputs import table
from .registry import query

BLOCK = 1000  # orders per document at most


def _price():
    """The order total as a JSON value: number, JSON null, quoted number or junk."""
    dec = F.col("o_totalprice").cast("decimal(18,2)")
    return (F.when(F.col("o_orderstatus") == "P", F.parse_json(F.lit("null")))
            .when(F.col("o_orderpriority") == "3-MEDIUM", dec.cast("string").cast("variant"))
            .when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"),
                  F.lit("n/a").cast("variant"))
            .otherwise(dec.cast("variant")))


def _day(c):
    return F.col(c).cast("date").cast("string")


def order_documents(spark, sf_dir):
    """``DF[doc_date, doc_block, value]``: one JSON array of orders per document,
    each order with its ``lines`` array (empty when it has none)."""
    # The structs are columns before they are collected: an aggregate evaluates its
    # input expression by expression, a projection is compiled.
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.struct(
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("extendedprice"),
        _day("l_shipdate").alias("shipdate")).alias("line"))
    lines = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    o = table(spark, sf_dir, "orders")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    empty = F.array().cast(lines.schema["lines"].dataType)
    obj = F.struct(
        F.col("o_orderkey").alias("orderkey"),
        _day("o_orderdate").alias("orderdate"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("order-priority"),
        _price().alias("totalprice"),
        F.coalesce(F.col("lines"), empty).alias("lines"))
    docs = (j.select(F.col("o_orderdate").cast("date").alias("doc_date"),
                     F.expr(f"o_orderkey div {BLOCK}").alias("doc_block"), obj.alias("order"))
            .groupBy("doc_date", "doc_block").agg(F.collect_list("order").alias("a")))
    # Orders sorted by key (a comparator: the variant field is not orderable),
    # then the whole document serialized once.
    by_key = F.array_sort("a", lambda x, y: F.when(x["orderkey"] < y["orderkey"], -1)
                          .when(x["orderkey"] > y["orderkey"], 1).otherwise(0))
    return docs.select("doc_date", "doc_block", F.to_json(by_key).alias("value"))


ORDER = {"orderkey": "bigint", "orderdate": "date", "status": "string", "order-priority": "string",
         "totalprice": "decimal(18,2)"}
LINE = {"linenumber": "int", "quantity": "decimal(18,2)", "extendedprice": "decimal(18,2)", "shipdate": "date"}


def decode_orders(docs, parsed: bool = False, at: str = "$", keys=tuple(ORDER), lines: bool = False):
    """M1-style decode: the array at a path (top-level) -> one typed row per order,
    of the wanted keys, with its array of typed lines on request."""
    types = {k: ORDER[k] for k in keys} | ({"lines": f"array<{fields(LINE)}>"} if lines else {})
    d = flatten(docs if parsed else parse_documents(docs), "raw", at, "o", keep=[], type_=fields(types))
    return d.select("o.*").withColumnRenamed("order-priority", "priority")


FLATTEN_ARRAY_SQL = """select o_orderkey as orderkey, cast(o_orderdate as date) as orderdate,
  o_orderstatus as status, o_orderpriority as priority,
  case when o_orderstatus = 'P' then null
       when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then null
       else cast(o_totalprice as decimal(18,2)) end as totalprice
from orders"""


@query("flatten_array", FLATTEN_ARRAY_SQL, "J1 J2 J3 F2")
def q_flatten_array(spark, sf_dir):
    return decode_orders(order_documents(spark, sf_dir))


FLATTEN_NULLS_SQL = f"select * from ({FLATTEN_ARRAY_SQL}) where totalprice is not null"


@query("flatten_nulls", FLATTEN_NULLS_SQL, "J9 T2")
def q_flatten_nulls(spark, sf_dir):
    return drop_null_observations(decode_orders(order_documents(spark, sf_dir)),
                                  "totalprice")


FLATTEN_NESTED_SQL = """select o_orderkey as orderkey, cast(o_orderdate as date) as orderdate,
  l_linenumber as linenumber, cast(l_quantity as decimal(18,2)) as quantity,
  cast(l_extendedprice as decimal(18,2)) as extendedprice, cast(l_shipdate as date) as shipdate
from orders join lineitem on l_orderkey = o_orderkey"""


@query("flatten_nested", FLATTEN_NESTED_SQL, "J4 J1")
def q_flatten_nested(spark, sf_dir):
    return order_lines(order_documents(spark, sf_dir))


def order_lines(docs, parsed: bool = False, at: str = "$"):
    """The second level: one typed row per line item of the decoded orders."""
    o = decode_orders(docs, parsed, at, keys=("orderkey", "orderdate"), lines=True)
    li = flatten(o, "lines", None, "l", keep=["orderkey", "orderdate"])
    return li.select("orderkey", "orderdate", "l.*")


JSON_PROFILE_SQL = f"""with o as (select cast(o_orderdate as date) as doc_date,
  o_orderkey // {BLOCK} as doc_block, o_orderkey from orders),
d as (select doc_date, doc_block, count(*) as n_orders, min(o_orderkey) as first_orderkey
  from o group by 1, 2),
n as (select l_orderkey, count(*) as c from lineitem group by 1)
select d.doc_date, d.doc_block, d.n_orders, d.first_orderkey,
  coalesce(n.c, 0) as first_n_lines
from d left join n on n.l_orderkey = d.first_orderkey"""


@query("json_profile", JSON_PROFILE_SQL, "J8 Q8")
def q_json_profile(spark, sf_dir):
    d = parse_documents(order_documents(spark, sf_dir))
    return d.select(
        "doc_date", "doc_block",
        F.size(path("raw", "$", "array<variant>")).cast("bigint").alias("n_orders"),
        path("raw", "$[0].orderkey", "bigint").alias("first_orderkey"),
        F.size(path("raw", "$[0].lines", "array<variant>")).cast("bigint").alias("first_n_lines"))


JSON_PATH_SQL = """select event_id, cast(json_extract(props, '$.k') as integer) as k,
  json_extract_string(props, '$."k"') as k_text from events"""


@query("json_path", JSON_PATH_SQL, "J1 J2 F2")
def q_json_path(spark, sf_dir):
    ev = parse_documents(table(spark, sf_dir, "events"), "props")
    return ev.select("event_id", path("raw", "$.k", "int").alias("k"),
                     path("raw", '$["k"]', "string").alias("k_text"))


def daily_documents(spark, sf_dir):
    """Parallel-array documents, one per (series, year): ``daily.time[i]``,
    ``daily.price[i]`` (NULL on the 1st of a month), ``daily.orders[i]`` (one
    element short: publication lag)."""
    o = table(spark, sf_dir, "orders")
    a = o.groupBy(F.col("o_orderpriority").alias("k"), F.col("o_orderdate").cast("date").alias("d")) \
        .agg(F.max("o_totalprice").cast("decimal(18,6)").alias("p"), F.count(F.lit(1)).alias("n"))
    g = a.groupBy("k", F.year("d").alias("y")).agg(
        F.sort_array(F.collect_list(F.struct("d", "p", "n"))).alias("a"))
    daily = F.struct(
        F.transform("a", lambda x: F.date_format(x["d"], "yyyy-MM-dd")).alias("time"),
        F.transform("a", lambda x: F.when(F.dayofmonth(x["d"]) != 1, x["p"])).alias("price"),
        F.slice(F.transform("a", lambda x: x["n"]), 1, F.size("a") - 1).alias("orders"))
    return g.select(F.to_json(F.struct(F.col("k").alias("series"), daily.alias("daily")))
                    .alias("value"))


ARRAY_ZIP_SQL = """with a as (select o_orderpriority as k, cast(o_orderdate as date) as d,
  cast(max(o_totalprice) as decimal(18,6)) as p, count(*) as n from orders group by 1, 2),
b as (select *, row_number() over (partition by k, year(d) order by d desc) as rd from a)
select k as series, d as obs_date, p as price, case when rd = 1 then null else n end as n_orders
from b where day(d) <> 1"""


@query("array_zip", ARRAY_ZIP_SQL, "J5 J9 T10 M3")
def q_array_zip(spark, sf_dir):
    d = parse_documents(daily_documents(spark, sf_dir))
    d = d.select("raw", path("raw", "$.series", "string").alias("series"))
    z = zip_arrays(d, "raw", "$.daily", "time",
                   {"price": ("price", "decimal(18,6)"), "n_orders": ("orders", "bigint")},
                   index_type="date", keep=["series"], index_name="obs_date")
    return drop_null_observations(z, "price")


def jsonstat_documents(spark, sf_dir):
    """JSON-stat documents, one per (return flag, year): the month index object
    and a sparse value object (February withheld)."""
    li = table(spark, sf_dir, "lineitem")
    m = li.groupBy(F.col("l_returnflag").alias("geo"),
                   F.trunc(F.col("l_shipdate").cast("date"), "month").alias("m")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("v"))
    idx = (F.month("m") - 1)
    g = m.groupBy("geo", F.year("m").alias("y")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.date_format("m", "yyyy-MM"), idx)))
        .alias("index"),
        F.map_from_entries(F.collect_list(F.when(F.month("m") != 2,
                                                 F.struct(idx.cast("string"), F.col("v")))))
        .alias("value"))
    doc = F.struct(F.col("geo"),
                   F.struct(F.struct(F.struct(F.col("index").alias("index")).alias("category"))
                            .alias("time")).alias("dimension"),
                   F.col("value"))
    return g.select(F.to_json(doc).alias("value"))


JSONSTAT_SQL = """select l_returnflag as geo, cast(date_trunc('month', l_shipdate) as date) as period_date,
  cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) as index_value
from lineitem where month(l_shipdate) <> 2 group by 1, 2"""


@query("jsonstat_decode", JSONSTAT_SQL, "J6 J7 F1 M4")
def q_jsonstat_decode(spark, sf_dir):
    d = parse_documents(jsonstat_documents(spark, sf_dir))
    d = d.select("raw", path("raw", "$.geo", "string").alias("geo"))
    s = decode_jsonstat(d, "raw", "decimal(18,2)", keep=["geo"], period="period",
                        value="index_value")
    s = drop_null_observations(s, "index_value")
    return s.select("geo", month_start("period").alias("period_date"), "index_value")
