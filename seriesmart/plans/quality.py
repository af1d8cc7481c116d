"""Registered queries: data-quality checks, freshness and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.quality import (accepted_range, accepted_values, freshness, not_null,
                                 reconcile, relationships, run_checks, unique)
from .inputs import table
from .registry import query

# Seeded defects, by data rule: pending orders lose their priority and point
# at a customer that does not exist; low-priority fulfilled orders get a
# negative total.
DQ_SQL = """dq as (select o_orderkey,
  o_custkey + case when o_orderstatus = 'P' then 1000000000 else 0 end as o_custkey,
  o_orderstatus, case when o_orderstatus = 'P' then null else o_orderpriority end as o_orderpriority,
  case when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then -o_totalprice
       else o_totalprice end as o_totalprice,
  cast(o_orderdate as date) as o_orderdate from orders)"""

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def defective_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    p = F.col("o_orderstatus") == "P"
    return o.select(
        "o_orderkey",
        (F.col("o_custkey") + F.when(p, F.lit(1000000000)).otherwise(F.lit(0))).alias("o_custkey"),
        "o_orderstatus",
        F.when(~p, F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"),
               -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"))


def _checks(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    return {
        "not_null": [not_null("o_orderkey"), not_null("o_orderpriority"), not_null("o_orderdate")],
        "unique": [unique("o_orderkey"), unique("o_custkey", severity="warn")],
        "relationships": [relationships("o_custkey", cust, "c_custkey")],
        "range": [accepted_range("o_totalprice", 0, inclusive=False),
                  accepted_range("o_orderdate", "1995-01-01", "2001-12-31")],
        "values": [accepted_values("o_orderstatus", ["F", "O"]),
                   accepted_values("o_orderpriority", PRIORITIES)],
    }


def _row_sql(name, kind, col, sev, cond):
    return (f"select '{name}' as check_name, '{kind}' as kind, '{col}' as column_name, "
            f"'{sev}' as severity, count(*) filter (where {cond}) as failures from dq")


_prio_list = ", ".join(f"'{p}'" for p in PRIORITIES)
SQL_PARTS = {
    "not_null": [
        _row_sql("not_null_o_orderkey", "not_null", "o_orderkey", "error", "o_orderkey is null"),
        _row_sql("not_null_o_orderpriority", "not_null", "o_orderpriority", "error",
                 "o_orderpriority is null"),
        _row_sql("not_null_o_orderdate", "not_null", "o_orderdate", "error", "o_orderdate is null"),
    ],
    "unique": [
        "select 'unique_o_orderkey' as check_name, 'unique' as kind, 'o_orderkey' as column_name, "
        "'error' as severity, cast(coalesce(sum(n), 0) as bigint) as failures from "
        "(select o_orderkey, count(*) as n from dq where o_orderkey is not null group by 1 having count(*) > 1)",
        "select 'unique_o_custkey', 'unique', 'o_custkey', 'warn', cast(coalesce(sum(n), 0) as bigint) from "
        "(select o_custkey, count(*) as n from dq where o_custkey is not null group by 1 having count(*) > 1)",
    ],
    "relationships": [
        "select 'relationships_o_custkey' as check_name, 'relationships' as kind, "
        "'o_custkey' as column_name, 'error' as severity, count(*) as failures from dq "
        "where o_custkey is not null and o_custkey not in (select c_custkey from customer "
        "where c_custkey is not null)",
    ],
    "range": [
        _row_sql("accepted_range_o_totalprice", "accepted_range", "o_totalprice", "error",
                 "o_totalprice is not null and not (o_totalprice > 0)"),
        _row_sql("accepted_range_o_orderdate", "accepted_range", "o_orderdate", "error",
                 "o_orderdate is not null and not (o_orderdate >= date '1995-01-01' "
                 "and o_orderdate <= date '2001-12-31')"),
    ],
    "values": [
        _row_sql("accepted_values_o_orderstatus", "accepted_values", "o_orderstatus", "error",
                 "o_orderstatus is not null and o_orderstatus not in ('F', 'O')"),
        _row_sql("accepted_values_o_orderpriority", "accepted_values", "o_orderpriority", "error",
                 f"o_orderpriority is not null and o_orderpriority not in ({_prio_list})"),
    ],
}


def _sql(*groups):
    parts = [p for g in groups for p in SQL_PARTS[g]]
    return f"with {DQ_SQL}\n" + "\nunion all\n".join(parts)


def _register(name, groups, ops):
    @query(name, _sql(*groups), ops)
    def q(spark, sf_dir):
        checks = _checks(spark, sf_dir)
        return run_checks(defective_orders(spark, sf_dir), [c for g in groups for c in checks[g]])
    return q


_register("check_not_null", ["not_null"], "Q1")
_register("check_unique", ["unique"], "Q2 Q7")
_register("check_relationships", ["relationships"], "Q3 K5")
_register("check_range", ["range"], "Q4")
_register("check_values", ["values"], "Q5 P4")
_register("quality_report", ["not_null", "unique", "relationships", "range", "values"], "Q9 Q1-Q5")


FRESH_RUN = "2024-01-31 00:00:00"
FRESHNESS_SQL = f"""select user_id, max(ts) as max_loaded_at,
  cast(floor(epoch(timestamp '{FRESH_RUN}' - max(ts))) as bigint) as age_seconds,
  case when max(ts) < timestamp '{FRESH_RUN}' - interval 50 hours then 'error'
       when max(ts) < timestamp '{FRESH_RUN}' - interval 26 hours then 'warn'
       else 'pass' end as status
from events group by user_id"""


@query("check_freshness", FRESHNESS_SQL, "Q6")
def q_check_freshness(spark, sf_dir):
    return freshness(table(spark, sf_dir, "events"), "ts", FRESH_RUN, by=["user_id"])


RECONCILE_SQL = """with a as (select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
    o_orderpriority from orders),
b as (select o_orderkey, o_custkey, o_orderstatus,
    case when o_orderpriority = '1-URGENT' and o_orderstatus = 'F' then o_totalprice + 1
         else o_totalprice end as o_totalprice, o_orderdate, o_orderpriority
  from orders where not (o_orderpriority = '5-LOW' and o_orderstatus = 'O')
  union all
  select o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderstatus = 'P'),
j as (select a.o_orderkey is not null as ina, b.o_orderkey is not null as inb,
    a.o_custkey is not distinct from b.o_custkey and a.o_orderstatus is not distinct from b.o_orderstatus
    and a.o_totalprice is not distinct from b.o_totalprice and a.o_orderdate is not distinct from b.o_orderdate
    and a.o_orderpriority is not distinct from b.o_orderpriority as same
  from a full outer join b on a.o_orderkey = b.o_orderkey)
select 'rows_a' as metric, count(*) filter (where ina) as value from j
union all select 'rows_b', count(*) filter (where inb) from j
union all select 'only_in_a', count(*) filter (where ina and not inb) from j
union all select 'only_in_b', count(*) filter (where inb and not ina) from j
union all select 'changed', count(*) filter (where ina and inb and not same) from j
union all select 'matched', count(*) filter (where ina and inb and same) from j"""


@query("table_reconcile", RECONCILE_SQL, "S14 U2")
def q_table_reconcile(spark, sf_dir):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
            "o_orderpriority"]
    a = table(spark, sf_dir, "orders").select(*cols)
    urgent_f = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    kept = a.filter(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "O")))
    kept = kept.withColumn("o_totalprice", F.when(urgent_f, F.col("o_totalprice") + 1)
                           .otherwise(F.col("o_totalprice")))
    added = a.filter(F.col("o_orderstatus") == "P").withColumn(
        "o_orderkey", F.col("o_orderkey") + 1000000000)
    return reconcile(a, kept.unionByName(added), ["o_orderkey"])
