"""Inputs derived from the driver's tables, as SQL both Spark and DuckDB run.

``{name}`` refers to a base table or to an earlier view.  Spark gets each view
as a DataFrame, DuckDB as a common table expression of the same text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS = {
    # Change log: one row per event, keyed by user.
    "v_cdc": """
        select user_id, event_id, event_type, cast(value as decimal(20,6)) as amount, props,
          cast(ts as timestamp) as event_ts,
          case event_type when 'signup' then 'REFRESH' when 'purchase' then 'INSERT'
            when 'error' then 'DELETE' else 'UPDATE' end as operation,
          concat(replace(replace(replace(substr(cast(cast(ts as timestamp) as varchar(30)),1,19),'-',''),':',''),' ',''),
            lpad(cast(event_id as varchar(20)),21,'0')) as change_sequence,
          cast(ts as timestamp) as hdr_timestamp, cast(ts as date) as ingest_date
        from {events}""",
    # Order items: the newest line per (order, line number).
    "v_items": """
        select cast(l_orderkey as int) as order_id, cast(l_linenumber as int) as id,
          cast(l_partkey as varchar(20)) as sku_number, cast(l_suppkey as varchar(20)) as ship_store_num,
          l_linestatus as order_status, l_returnflag as item_type,
          cast(l_extendedprice as decimal(20,6)) as unit_price, cast(l_quantity as int) as quantity,
          'STATE' as tax_type, cast(l_tax as decimal(20,6)) as tax,
          'CITY' as tax_type2, cast(l_discount as decimal(20,6)) as tax2,
          cast(l_tax + l_discount as decimal(20,6)) as vat,
          cast(l_shipdate as date) as ship_date, cast(l_shipdate as timestamp) as charge_timestamp,
          cast(l_shipdate as timestamp) as rec_update_timestamp
        from (select *, row_number() over (partition by l_orderkey, l_linenumber
                order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc,
                  l_quantity desc, l_discount desc, l_tax desc) as rn from {lineitem}) x
        where rn = 1""",
    # Every line, repeated (order, line number) pairs included.
    "v_lines": """
        select cast(l_orderkey as int) as order_id, cast(l_linenumber as int) as id,
          cast(l_partkey as varchar(20)) as sku_number, cast(l_suppkey as varchar(20)) as ship_store_num,
          l_linestatus as order_status, l_returnflag as item_type,
          cast(l_extendedprice as decimal(20,6)) as unit_price, cast(l_quantity as int) as quantity,
          'STATE' as tax_type, cast(l_tax as decimal(20,6)) as tax,
          'CITY' as tax_type2, cast(l_discount as decimal(20,6)) as tax2,
          cast(l_tax + l_discount as decimal(20,6)) as vat,
          cast(l_shipdate as date) as ship_date, cast(l_shipdate as timestamp) as charge_timestamp,
          cast(l_shipdate as timestamp) as rec_update_timestamp
        from {lineitem}""",
    # The newest lines after a change: the returned ones have one piece more.
    "v_changed_items": """
        select order_id, id, sku_number, ship_store_num, order_status, item_type, unit_price,
          cast(case item_type when 'R' then quantity + 1 else quantity end as int) as quantity,
          tax_type, tax, tax_type2, tax2, vat, ship_date, charge_timestamp,
          case when item_type = 'R' or id = 1 then rec_update_timestamp + interval 4000 day
            else rec_update_timestamp end as rec_update_timestamp
        from {v_items}""",
    "v_order_log": """
        select cast(o_orderkey as int) as order_id, cast(c_nationkey as varchar(20)) as store_num,
          cast(o_orderdate as timestamp) + interval 0 day as order_timestamp,
          concat('CUR', cast(c_nationkey as varchar(20))) as currency_code
        from {orders} left join {customer} on o_custkey = c_custkey""",
    # Every seventh order has no time of order.
    "v_undated_log": """
        select order_id, store_num, case when order_id % 7 = 0 then null else order_timestamp end as order_timestamp, currency_code
        from {v_order_log}""",
    # The same after a correction: no order is left on the first of a month.
    "v_moved_log": """
        select order_id, store_num, currency_code,
          case when extract(day from order_timestamp) = 1 then order_timestamp + interval 1 day else order_timestamp end as order_timestamp
        from {v_undated_log}""",
    # Every item sent again.
    "v_resent_items": """
        select order_id, id, sku_number, ship_store_num, order_status, item_type, unit_price, quantity, tax_type, tax, tax_type2, tax2,
          vat, ship_date, charge_timestamp, rec_update_timestamp + interval 4000 day as rec_update_timestamp
        from {v_items}""",
    # Two validity versions per store.
    "v_mst_store": """
        select cast(s_suppkey*10+v as int) as store_rhid, concat('G',cast(s_suppkey as varchar(20))) as store_grpid,
          cast(s_nationkey as int) as primary_store_currency_rhid,
          concat('C',cast(s_nationkey as varchar(20))) as primary_store_currency_grpid,
          case v when 1 then timestamp '1900-01-01 00:00:00' else timestamp '1998-07-01 00:00:00' end
            as effective_start_timestamp,
          case v when 1 then timestamp '1998-06-30 23:59:59.999999' else timestamp '2099-12-31 00:00:00' end
            as effective_end_timestamp,
          case v when 1 then date '1990-01-01' else date '1998-07-01' end as store_open_date,
          case v when 1 then date '1998-06-30' else cast(null as date) end as store_close_date
        from (select *, 1 as v from {supplier} union all select *, 2 as v from {supplier}) x""",
    "v_mst_product": """
        select cast(p_partkey as int) as product_rhid, concat('P',cast(p_partkey as varchar(20))) as product_grpid,
          case p_type when 'MEDIUM' then 1 when 'LARGE' then 1 when 'SMALL' then 2 when 'PROMO' then 2
            when 'STANDARD' then 3 else null end as product_line_rhid,
          cast(p_size as int) as size_rhid, p_brand as style_grpid,
          timestamp '1900-01-01 00:00:00' as effective_start_timestamp,
          timestamp '2099-12-31 00:00:00' as effective_end_timestamp
        from {part}""",
    "v_mst_product_line": """
        select cast(n_regionkey as int) as product_line_rhid,
          case n_regionkey when 1 then 'FOOTWEAR' when 2 then 'APPAREL' when 3 then 'ACCESSORIES' else r_name end
            as product_line_desc,
          case n_regionkey when 1 then '4' when 2 then '2' when 3 then '1' else 'none' end as product_line_code
        from (select distinct n_regionkey from {nation}) n join {region} on n_regionkey = r_regionkey""",
    "v_mst_currency": """
        select cast(n_nationkey as int) as currency_rhid, concat('C',cast(n_nationkey as varchar(20))) as currency_grpid,
          timestamp '1900-01-01 00:00:00' as effective_start_timestamp,
          timestamp '2099-12-31 00:00:00' as effective_end_timestamp
        from {nation}""",
    # Source keys of the masters; stores in debt and economy products are unmapped.
    "v_src_hub": """
        select 3 as source_system_id, concat(cast(s_suppkey as varchar(20)),'_3') as source_system_natural_key,
          concat('G',cast(s_suppkey as varchar(20))) as grpid, 'MST_STORE' as ref_hub_table_name
        from {supplier} where s_acctbal > 0
        union all
        select 4, concat('W',cast(s_suppkey as varchar(20)),'_4'), concat('G',cast(s_suppkey as varchar(20))), 'MST_STORE'
        from {supplier} where s_acctbal > 0
        union all
        select 3, concat(cast(p_partkey as varchar(20)),'_3'), concat('P',cast(p_partkey as varchar(20))), 'MST_PRODUCT'
        from {part} where p_type <> 'ECONOMY'
        union all
        select 3, concat('CUR',cast(n_nationkey as varchar(20)),'_3'), concat('C',cast(n_nationkey as varchar(20))),
          'MST_CURRENCY' from {nation} where n_regionkey <> 4""",
    # Stores that point into every dimension of the hierarchy, some nowhere.
    "v_store_links": """
        select cast(s_suppkey as int) as store_rhid, s_name as store_name,
          cast(case when s_suppkey % 5 = 0 then null else s_nationkey end as int) as geo_location_rhid,
          cast(s_suppkey % 7 as int) as store_type_rhid, cast(s_suppkey % 11 as int) as location_type_rhid,
          cast(s_suppkey % 13 as int) as ownership_type_rhid, cast(s_suppkey % 17 as int) as retail_district_rhid,
          cast(s_suppkey % 19 as int) as retail_region_rhid, cast(s_suppkey % 23 as int) as retail_territory_rhid,
          cast(s_suppkey % 29 as int) as distribution_center_rhid, cast(s_suppkey * 3 as int) as customer_rhid,
          cast(s_suppkey % 31 as int) as customer_type_rhid, cast(s_suppkey % 37 as int) as suboffice_rhid,
          cast(s_suppkey % 41 as int) as company_rhid, cast(s_suppkey % 24 as int) as time_zone_rhid,
          cast(s_suppkey % 6 as int) as climate_region_rhid, cast(s_nationkey % 5 as int) as region_rhid
        from {supplier}""",
    "v_src_sys": """
        select distinct 3 as source_system_id, 'POS' as source_system_name from {region}
        union all select distinct 4, 'WEB' from {region}""",
    "v_traffic": """
        select cast(user_id as varchar(20)) as store_number, cast(ts as date) as visit_date,
          year(ts)*10000 + month(ts)*100 + day(ts) as visit_date_key,
          cast(floor(value) as int) as entries, cast(floor(value/2) as int) as exits,
          cast(ts as timestamp) as rec_update_timestamp
        from {events}""",
    # The same readings; of every second day a fifth arrive two months late.
    "v_late_traffic": """
        select cast(user_id as varchar(20)) as store_number, cast(ts as date) as visit_date,
          year(ts)*10000 + month(ts)*100 + day(ts) as visit_date_key,
          cast(floor(value) as int) as entries, cast(floor(value/2) as int) as exits,
          case when day(ts) % 2 = 0 and second(cast(ts as timestamp)) % 5 = 0 then cast(ts as timestamp) + interval 60 day
            else cast(ts as timestamp) end as rec_update_timestamp
        from {events}""",
    # Register lines with a 12-hour clock text; returned items carry an unknown size.
    "v_sales": """
        select cast(l_suppkey as varchar(20)) as sl_store, cast(l_shipdate as date) as sl_date,
          concat(case (l_linenumber+l_partkey) % 12 when 0 then '12'
              else lpad(cast((l_linenumber+l_partkey) % 12 as varchar(2)),2,'0') end,
            ':30 ', case when l_partkey % 2 = 0 then 'pm' else 'am' end) as sl_time,
          cast(l_linenumber as int) as sl_tran, cast(l_orderkey as int) as sl_inv_num, l_linestatus as sl_trantype,
          cast(p_partkey as int) as sl_seq,
          case l_returnflag when 'R' then 'none' else cast(p_size as varchar(10)) end as sl_size_id,
          p_brand as sl_eitem, cast(l_quantity as int) as sl_qty, cast(l_extendedprice as decimal(20,6)) as sl_price,
          l_returnflag as sl_taxmode, cast(l_tax as decimal(20,6)) as sl_taxamt1,
          cast(l_discount as decimal(20,6)) as sl_taxamt2
        from {lineitem} left join {part} on l_partkey = p_partkey""",
    "v_upcref": """
        select cast(p_partkey as int) as up_seq, cast(p_size as varchar(10)) as up_size,
          cast(p_partkey as varchar(20)) as up_code
        from {part}""",
    # Sales fact lines for the daily metrics; economy parts have no product, some lines no store.
    "v_fact": """
        select cast(l_orderkey as int) as order_id,
          case when s_acctbal > 0 then cast(l_suppkey*10 + case when l_shipdate < timestamp '1998-07-01 00:00:00'
            then 1 else 2 end as int) else null end as store_rhid,
          year(l_shipdate)*10000 + month(l_shipdate)*100 + day(l_shipdate) as order_date_key,
          case when p_type <> 'ECONOMY' then cast(l_partkey as int) else null end as product_rhid,
          cast(l_quantity as int) as sales_qty, cast(l_extendedprice as decimal(20,6)) as unit_price_amt,
          cast(l_tax as decimal(20,6)) as tax_type1_amt, cast(l_discount as decimal(20,6)) as tax_type2_amt,
          cast(null as decimal(20,6)) as tax_type3_amt, cast(null as decimal(20,6)) as tax_type4_amt
        from {lineitem} join {supplier} on l_suppkey = s_suppkey join {part} on l_partkey = p_partkey""",
    # Visit rows of the stores, dated by the orders their customers placed.
    "v_visits": """
        select store_rhid, visit_date_key, cast(sum(n) as bigint) as entry_count
        from (select cast(c_nationkey*10 + case when o_orderdate < timestamp '1998-07-01 00:00:00' then 1 else 2 end
                as int) as store_rhid,
              year(o_orderdate)*10000 + month(o_orderdate)*100 + day(o_orderdate) as visit_date_key, 1 as n
            from {orders} join {customer} on o_custkey = c_custkey) x
        group by store_rhid, visit_date_key""",
    # Load audit: each event is a run of its type's load job.
    "v_audit": """
        select concat('load ', event_type) as jobname, cast(ts as timestamp) as src_last_upd_timestamp,
          case when ts < timestamp '2024-01-20 00:00:00' then 'COMPLETED' else null end as load_status,
          cast(ts as timestamp) as rec_create_timestamp, concat('load ', event_type) as rec_create_user_name,
          case when ts < timestamp '2024-01-20 00:00:00' then cast(ts as timestamp) else null end
            as rec_update_timestamp,
          cast(null as varchar(20)) as rec_update_user_name
        from {events}""",
}

_NAME = re.compile(r"\{(\w+)\}")


def frame(spark: SparkSession, sf_dir: str, name: str, given: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A base table or a view as a DataFrame; ``given`` has frames to take instead of those of their names."""
    if given and name in given:
        return given[name]
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    return spark.sql(text, **{n: frame(spark, sf_dir, n, given) for n in dict.fromkeys(_NAME.findall(text))})


def landed_by_order(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Order items and order log landed once, as tables bucketed by order, by the names of their views.

    The lines are dealt by order before the newest is picked, so they are moved
    once; no load that reads them, its high mark included, moves them again.
    """
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = frame(spark, sf_dir, "lineitem").withColumn("l_orderkey", F.col("l_orderkey").cast("int"))
    items = frame(spark, sf_dir, "v_items", {"lineitem": lines.repartition(buckets, "l_orderkey")})
    log = frame(spark, sf_dir, "v_order_log").repartition(buckets, "order_id")
    landed = {}
    for name, rows in (("v_items", items), ("v_order_log", log)):
        table = f"landed_{name}_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(buckets, "order_id").sortBy("order_id").saveAsTable(table)
        landed[name] = spark.table(table)
    return landed


def _needed(text: str, found: dict[str, None]) -> dict[str, None]:
    for name in _NAME.findall(text):
        if name in VIEWS and name not in found:
            _needed(VIEWS[name], found)
            found[name] = None
    return found


def duck(query: str) -> str:
    """The query for DuckDB, the views it names put in front of it."""
    used = _needed(query, {})
    ctes = [f"{n} as ({_NAME.sub(r'\1', VIEWS[n]).strip()})" for n in used]
    body = _NAME.sub(r"\1", query).strip()
    if not ctes:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(ctes) + ",\n" + body[5:]
    return "with " + ",\n".join(ctes) + "\n" + body
