"""The same results in DuckDB SQL, written as the use cases state them.

The lookups keep the concatenated natural-key condition, the merge is a full
outer join, the metrics really fan out: none of the rewrites the Spark side
makes are repeated here.
"""

from __future__ import annotations

from tidemark.schemas import AGG_STORE_METRICS_DAILY, DTL_RETAIL_SALES
from workload.inputs import duck

NOW = "timestamp '2024-02-01 10:11:12.345678'"
SECOND = "timestamp '2024-02-01 10:11:12'"


def utc(local: str) -> str:
    """Los Angeles time to UTC; of an ambiguous autumn hour the earlier instant."""
    later = f"timezone('UTC', timezone('America/Los_Angeles', {local}))"
    earlier = f"({later} - interval 1 hour)"
    return (
        f"(case when timezone('America/Los_Angeles', timezone('UTC', {earlier})) = {local}"
        f" then {earlier} else {later} end)"
    )


def day_key(ts: str) -> str:
    return f"cast(strftime({ts}, '%Y%m%d') as int)"


META = f"""{SECOND} as rec_create_timestamp, 'DL User' as rec_create_user_name,
  {SECOND} as rec_update_timestamp, case when operation = 'UPDATE' then 'DL User' else '' end as rec_update_user_name,
  20240201 as rec_create_date_key, 101112 as rec_create_time_key, operation as rec_crud_text,
  cast(operation = 'DELETE' as int) as delete_ind, 0 as exception_ind, 0 as resolved_ind"""
HEADER = """case when operation = 'REFRESH' then timestamp '1970-01-01 00:00:00' else hdr_timestamp end as hdr_timestamp,
  case when operation = 'REFRESH' then '1970010100000000' else change_sequence end as "changeSequence\""""
META_NAMES = (
    "rec_create_timestamp", "rec_create_user_name", "rec_update_timestamp", "rec_update_user_name",
    "rec_create_date_key", "rec_create_time_key", "rec_crud_text", "delete_ind", "exception_ind", "resolved_ind",
)
EVENT = "user_id, event_id, event_type, amount, props, event_ts"
FLAT = f"flat as (select {EVENT}, {META}, {HEADER} from {{v_cdc}})"
HASHED = "sha256(concat_ws('||', {}))"

INCOMPLETE = f"""{FLAT}, rows as (select case when event_type <> 'error' then user_id end as user_id, event_id,
    case when event_type = 'click' then '' else props end as props,
    case when event_type <> 'view' then amount end as amount,
    rec_create_date_key, rec_crud_text, exception_ind, "changeSequence", hdr_timestamp from flat)"""


def null_rule(keys: str) -> str:
    blank = " or ".join(f"coalesce(cast({k} as varchar), '') = ''" for k in keys.split())
    return (
        f"case when {blank} then 'NullCheckForPKs' "
        "when coalesce(props, '') = '' or amount is null then 'NullCheckForNotNullCols' end"
    )


def hub(table: str, master: str, group: str, columns: str, system: str | None) -> str:
    only = f" and s.source_system_name = '{system}'" if system else ""
    listed = ", ".join(f"m.{c}" for c in columns.split())
    return f"""select h.source_system_id, s.source_system_name, h.source_system_natural_key,
      regexp_replace(h.source_system_natural_key, '_' || h.source_system_id || '$', '') as hub_code,
      {listed}, m.effective_start_timestamp, m.effective_end_timestamp
    from {{v_src_hub}} h join {{v_src_sys}} s on s.source_system_id = h.source_system_id
      join {{{master}}} m on h.grpid = m.{group}
    where h.ref_hub_table_name = '{table}'{only}"""


STORE_HUB = hub(
    "MST_STORE", "v_mst_store", "store_grpid",
    "store_rhid store_grpid primary_store_currency_rhid primary_store_currency_grpid", "POS",
)
PRODUCT_HUB = hub(
    "MST_PRODUCT", "v_mst_product", "product_grpid",
    "product_rhid product_grpid product_line_rhid size_rhid style_grpid", None,
)
CURRENCY_HUB = hub("MST_CURRENCY", "v_mst_currency", "currency_grpid", "currency_rhid currency_grpid", "POS")
HUBS = f"store_hub as ({STORE_HUB}), product_hub as ({PRODUCT_HUB}), currency_hub as ({CURRENCY_HUB})"


def at_hub(name: str, alias: str, code: str, ts: str, end: str = "<=") -> str:
    return f"""left join {name} {alias} on {code} || '_' || {alias}.source_system_id = {alias}.source_system_natural_key
      and {ts} >= {alias}.effective_start_timestamp and {ts} {end} {alias}.effective_end_timestamp"""


def asof(name: str, code: str, columns: dict[str, str], side: str, end: str = "<=") -> str:
    listed = ", ".join(f"h.{c} as {out}" for c, out in columns.items())
    return f"""with {HUBS} select i.order_id, i.id as order_item_id, {side}.{code}, o.order_timestamp, {listed}
    from {{v_lines}} i join {{v_order_log}} o on i.order_id = o.order_id
    {at_hub(name, "h", f"{side}.{code}", "o.order_timestamp", end)}"""


def fact(values: dict[str, str]) -> str:
    """All 62 fact columns, the given ones computed, the others null."""
    stamp = {
        "rec_create_timestamp": NOW, "rec_create_user_name": "'nightly'",
        "rec_update_timestamp": NOW, "rec_update_user_name": "'nightly'",
        "rec_create_date_key": "20240201", "rec_create_time_key": "1011",
    }
    given = values | stamp
    return ", ".join(
        f"cast({given.get(f.name, 'null')} as {f.dataType.simpleString().replace('string', 'varchar')}) as {f.name}"
        for f in DTL_RETAIL_SALES.fields
    )


ECOM = f"""with {HUBS},
store_part as (select distinct i.order_id, i.id, h.store_rhid, h.store_grpid
  from {{v_items}} i join {{v_order_log}} o on i.order_id = o.order_id
  {at_hub("store_hub", "h", "o.store_num", "o.order_timestamp")}),
ship_part as (select distinct i.order_id, i.id, h.store_rhid, h.store_grpid
  from {{v_items}} i join {{v_order_log}} o on i.order_id = o.order_id
  {at_hub("store_hub", "h", "i.ship_store_num", "o.order_timestamp")}),
currency_part as (select distinct i.order_id, i.id, h.currency_rhid, h.currency_grpid
  from {{v_items}} i join {{v_order_log}} o on i.order_id = o.order_id
  {at_hub("currency_hub", "h", "o.currency_code", "o.order_timestamp")}),
product_part as (select distinct i.*, o.order_timestamp, h.product_rhid, h.product_grpid, h.size_rhid, h.style_grpid
  from {{v_items}} i join {{v_order_log}} o on i.order_id = o.order_id
  {at_hub("product_hub", "h", "i.sku_number", "o.order_timestamp")})
select distinct {fact({
    "order_id": "p.order_id", "order_item_id": "p.id", "order_status_code": "p.order_status",
    "order_channel_code": "'ECOM'", "order_timestamp": "p.order_timestamp",
    "order_date_key": day_key("p.order_timestamp"), "product_rhid": "p.product_rhid",
    "product_grpid": "p.product_grpid", "size_rhid": "p.size_rhid", "style_grpid": "p.style_grpid",
    "store_rhid": "s.store_rhid", "store_grpid": "s.store_grpid",
    "ship_store_rhid": "t.store_rhid", "ship_store_grpid": "t.store_grpid",
    "item_type_desc": "p.item_type", "unit_price_amt": "p.unit_price", "sales_qty": "p.quantity",
    "tax_type1_code": "p.tax_type", "tax_type1_amt": "p.tax", "tax_type2_code": "p.tax_type2",
    "tax_type2_amt": "p.tax2", "tax_type3_code": "'VAT'", "tax_type3_amt": "p.vat", "ship_date": "p.ship_date",
    "charge_timestamp": utc("p.charge_timestamp"), "currency_rhid": "c.currency_rhid",
    "currency_grpid": "c.currency_grpid",
})}
from product_part p join store_part s on p.order_id = s.order_id and p.id = s.id
  join ship_part t on p.order_id = t.order_id and p.id = t.id
  join currency_part c on p.order_id = c.order_id and p.id = c.id"""  # fmt: skip

LOCAL_SALE = "strptime(cast(x.sl_date as varchar) || ' ' || x.sl_time, '%Y-%m-%d %I:%M %p')"
SALE_VALUES = {
    "order_id": "x.sl_inv_num", "order_item_id": "x.sl_tran", "order_channel_code": "'RETAIL'",
    "transaction_type_code": "x.sl_trantype", "order_timestamp": utc(LOCAL_SALE),
    "order_date_key": day_key("x.sl_date"), "product_rhid": "p.product_rhid", "product_grpid": "p.product_grpid",
    "size_rhid": "p.size_rhid", "style_grpid": "p.style_grpid", "catalog_item_code": "x.sl_eitem",
    "store_rhid": "s.store_rhid", "store_grpid": "s.store_grpid", "unit_price_amt": "x.sl_price",
    "sales_qty": "x.sl_qty", "tax_type1_code": "x.sl_taxmode", "tax_type1_amt": "x.sl_taxamt1",
    "tax_type2_amt": "x.sl_taxamt2", "currency_rhid": "s.primary_store_currency_rhid",
    "currency_grpid": "s.primary_store_currency_grpid",
}
SALE_PRODUCT = f"""left join {{v_upcref}} u on x.sl_seq = u.up_seq and x.sl_size_id = u.up_size
  left join product_hub p on u.up_code || '_' || p.source_system_id = p.source_system_natural_key
    and p.source_system_name = 'POS'
    and x.sl_date >= p.effective_start_timestamp and x.sl_date <= p.effective_end_timestamp"""

RETAIL_KEYED = f"""with {HUBS},
store_half as (select x.sl_inv_num as order_id, x.sl_tran as order_item_id, {day_key("x.sl_date")} as order_date_key,
    h.store_rhid, h.store_grpid, h.primary_store_currency_rhid, h.primary_store_currency_grpid
  from {{v_sales}} x {at_hub("store_hub", "h", "x.sl_store", "x.sl_date")}),
product_half as (select distinct x.*, p.product_rhid, p.product_grpid, p.size_rhid, p.style_grpid,
    t.store_rhid as paired_store
  from {{v_sales}} x {SALE_PRODUCT}
  left join (select distinct order_id, order_item_id, order_date_key, store_rhid from store_half) t
    on x.sl_inv_num = t.order_id and x.sl_tran = t.order_item_id and {day_key("x.sl_date")} = t.order_date_key)
select distinct {fact(SALE_VALUES | {c: f"x.{c}" for c in ("product_rhid", "product_grpid", "size_rhid", "style_grpid")})}
from product_half x join store_half s on x.sl_inv_num = s.order_id and x.sl_tran = s.order_item_id
  and x.paired_store is not distinct from s.store_rhid and {day_key("x.sl_date")} = s.order_date_key"""

RETAIL_LINE = f"""with {HUBS} select distinct {fact(SALE_VALUES)}
from {{v_sales}} x {SALE_PRODUCT} {at_hub("store_hub", "s", "x.sl_store", "x.sl_date")}"""


def visits_sql(source: str, hub: str = "store_hub") -> str:
    return f"""select t.visit_date_key, coalesce(h.store_rhid, -1) as store_rhid, h.store_grpid, t.visit_date,
      cast(sum(t.entries) as bigint) as entry_count, cast(sum(t.exits) as bigint) as exit_count
    from {source} t {at_hub(hub, "h", "t.store_number", "t.visit_date")}
    group by 1, 2, 3, 4"""


VISIT_STAMP = """{ts} as rec_create_timestamp, '{job}' as rec_create_user_name, {ts} as rec_update_timestamp,
  '{job}' as rec_update_user_name, {key} as rec_create_date_key, 0 as rec_create_time_key"""

VISITS_MERGE = f"""with {HUBS},
first_hub as (select * from store_hub where store_grpid not like '%5'),
early as (select * from {{v_late_traffic}} where rec_update_timestamp < timestamp '2024-02-15 00:00:00'),
late_days as (select distinct visit_date from {{v_late_traffic}}
  where rec_update_timestamp >= timestamp '2024-02-15 00:00:00'),
again as (select v.* from {{v_late_traffic}} v where v.visit_date in (select visit_date from late_days)),
t as (select *, {VISIT_STAMP.format(ts="timestamp '2024-01-16 00:00:00'", job="first", key=20240116)}
  from ({visits_sql("early", "first_hub")}) a),
s as (select *, {VISIT_STAMP.format(ts="timestamp '2024-02-01 00:00:00'", job="second", key=20240201)}
  from ({visits_sql("again")}) b)
select coalesce(s.visit_date_key, t.visit_date_key) as visit_date_key,
  coalesce(s.store_rhid, t.store_rhid) as store_rhid,
  case when s.store_rhid is null then t.store_grpid else s.store_grpid end as store_grpid,
  coalesce(s.visit_date, t.visit_date) as visit_date,
  coalesce(s.entry_count, t.entry_count) as entry_count, coalesce(s.exit_count, t.exit_count) as exit_count,
  coalesce(t.rec_create_timestamp, s.rec_create_timestamp) as rec_create_timestamp,
  coalesce(t.rec_create_user_name, s.rec_create_user_name) as rec_create_user_name,
  coalesce(s.rec_update_timestamp, t.rec_update_timestamp) as rec_update_timestamp,
  coalesce(s.rec_update_user_name, t.rec_update_user_name) as rec_update_user_name,
  coalesce(t.rec_create_date_key, s.rec_create_date_key) as rec_create_date_key,
  coalesce(t.rec_create_time_key, s.rec_create_time_key) as rec_create_time_key
from t full join s on t.store_rhid = s.store_rhid and t.visit_date = s.visit_date
where s.store_rhid is not null or t.visit_date not in (select visit_date from late_days)"""


def metrics_sql(per_day: bool) -> str:
    tax = " + ".join(f"coalesce(f.tax_type{i}_amt, 0)" for i in range(1, 5))
    money = "cast({} as decimal(20,6)) as {}"

    def block(prefix: str, condition: str | None) -> list[str]:
        def total(value: str) -> str:
            return f"sum({value})" if condition is None else f"sum(case when {condition} then {value} else 0 end)"

        count = "count(f.order_id)" if condition is None else f"count(case when {condition} then 1 end)"
        return [
            f"cast({count} as bigint) as {prefix}_transaction_count",
            f"cast({total('coalesce(f.sales_qty, 0)')} as bigint) as {prefix}_sales_quantity",
            money.format(total("coalesce(f.unit_price_amt, 0)"), f"{prefix}_sales_usd_amount"),
            money.format(total(f"({tax})"), f"{prefix}_tax_usd_amount"),
            f"cast(null as bigint) as {prefix}_return_quantity",
            *[money.format("null", f"{prefix}_{m}_usd_amount") for m in ("discount", "promo", "shipping")],
        ]

    lines = {"FOOTWEAR": "4", "APPAREL": "2", "ACCESSORIES": "1"}
    columns = block("total", None)
    for name, code in lines.items():
        columns += block(name.lower(), f"l.product_line_desc = '{name}' and l.product_line_code = '{code}'")
    visited = "cast(max(v.entry_count) as bigint)" if per_day else "cast(sum(v.entry_count) as bigint)"
    on_day = " and f.order_date_key = v.visit_date_key" if per_day else ""
    return f"""select f.order_date_key as date_key, coalesce(f.store_rhid, -1) as store_rhid,
      max(m.store_open_date) as latest_open_date, max(m.store_close_date) as latest_close_date,
      {visited} as total_visit_count, {", ".join(columns)}
    from {{v_fact}} f left join {{v_mst_store}} m on coalesce(f.store_rhid, -1) = m.store_rhid
      left join {{v_visits}} v on m.store_rhid = v.store_rhid{on_day}
      left join {{v_mst_product}} p on coalesce(f.product_rhid, -1) = p.product_rhid
      left join {{v_mst_product_line}} l on p.product_line_rhid = l.product_line_rhid
        and l.product_line_desc in ('FOOTWEAR', 'APPAREL', 'ACCESSORIES') and l.product_line_code in ('1', '2', '4')
    group by 1, 2"""


def gold_end_to_end(per_day: bool = False, items: str = "{v_items}", order_log: str = "{v_order_log}") -> str:
    """The metrics over the online fact and the visits, in the gold table's types."""
    text = metrics_sql(per_day).replace("{v_fact}", "fact").replace("{v_visits}", "seen")
    typed = ", ".join(
        f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}"
        for f in AGG_STORE_METRICS_DAILY.fields
        if not f.name.startswith("rec_")
    )
    parts, fact_rows = ECOM.replace("{v_items}", items).replace("{v_order_log}", order_log).rsplit("\nselect distinct", 1)
    return f"""{parts}, fact as (select distinct{fact_rows}),
        seen as ({visits_sql("{v_traffic}")}) select {typed} from ({text}) g"""


STATES = f"""{FLAT},
early as (select * from (select *, row_number() over (partition by user_id
    order by "changeSequence" desc, hdr_timestamp desc, event_id desc) as rn
  from flat where event_ts < timestamp '2024-01-16 00:00:00') a where rn = 1),
late as (select * replace (timestamp '2024-03-01 00:00:00' as rec_create_timestamp,
    timestamp '2024-03-01 00:00:00' as rec_update_timestamp,
    case when event_type <> 'view' then props end as props)
  from (select *, row_number() over (partition by user_id
    order by "changeSequence" desc, hdr_timestamp desc, event_id desc) as rn
  from flat where event_ts >= timestamp '2024-01-16 00:00:00') b where rn = 1)"""
STATE_COLUMNS = [
    *EVENT.split(", "), "rec_update_timestamp", "rec_create_user_name", "rec_update_user_name",
    "rec_create_date_key", "rec_create_time_key", "rec_crud_text", "delete_ind", "exception_ind", "resolved_ind",
    "hdr_timestamp", "change_sequence",
]


def merge_sql(target: str, source: str, guarded: bool) -> str:
    source_wins = "s.user_id is not null"
    if guarded:
        source_wins += ' and (t.user_id is null or s."changeSequence" >= t."changeSequence")'
    listed = ", ".join(
        "case when {0} then s.{1} else t.{1} end as {2}".format(
            source_wins, '"changeSequence"' if c == "change_sequence" else c, c
        )
        for c in STATE_COLUMNS
    )
    return f"""with {STATES} select {listed},
      case when t.user_id is null then s.rec_create_timestamp else t.rec_create_timestamp end as rec_create_timestamp
    from {target} t full join {source} s on t.user_id = s.user_id"""


def ranked(partition: str) -> str:
    return f"""ranked as (select *, row_number() over (partition by {partition}
      order by "changeSequence" desc, hdr_timestamp desc, event_id desc) as _rank from rows)"""


ROW_STATE = """state as (select * from (select *, row_number() over (partition by jobname, rec_create_timestamp
    order by (load_status is not null) desc, rec_update_timestamp desc nulls last) as rn from {v_audit}) a where rn = 1)"""

WHOLE_ROW = "sha256(concat_ws('||', {0}user_id, {0}event_id, {0}event_type, {0}amount, {0}props, {0}event_ts))"

# Rows of the current table as the stream job keeps it.
LATEST = f"""
    with {FLAT}
    select {EVENT}, {", ".join(META_NAMES)}, "changeSequence" as change_sequence,
      {WHOLE_ROW.format("")} as rec_row_hash, sha256(concat_ws('||', user_id, rec_crud_text)) as rec_pk_hash
    from (select *, row_number() over (partition by user_id
      order by "changeSequence" desc, hdr_timestamp desc, event_id desc) as rn from flat) x where rn = 1"""

FEED = """select event_id, amount, event_ts as timestamp, substr(operation, 1, 1) as flag from {v_cdc}"""

# A reload wins over what is stored, with the lowest sequence and its own operation.
RELOAD = (
    f"""with {STATES}, again as (select * replace ('REFRESH' as rec_crud_text,
      '1970010100000000' as "changeSequence") from early)"""
    + merge_sql("late", "again", False).removeprefix(f"with {STATES}")
)

LINKS = (
    "geo_location_rhid store_type_rhid location_type_rhid ownership_type_rhid retail_district_rhid retail_region_rhid "
    "retail_territory_rhid distribution_center_rhid customer_type_rhid suboffice_rhid company_rhid time_zone_rhid "
    "climate_region_rhid"
).split()


def hierarchy_sql() -> str:
    """Every nation-made dimension through the store's own link, region and customer apart."""
    named = {link: link.removesuffix("_rhid") for link in LINKS} | {"time_zone_rhid": "timezone"}
    shown = [f"'{name} ' || {name}.n_name as {name}_label" for name in named.values()]
    joins = [f"left join {{nation}} {name} on s.{link} = {name}.n_nationkey" for link, name in named.items()]
    return f"""select s.*, {", ".join(shown)}, 'address ' || geo_location.n_name as address_label,
          c.c_name as customer_label, cast(c.c_nationkey as int) as customer_currency_rhid,
          'currency ' || money.n_name as currency_label, 'region ' || r.r_name as region_label
        from {{v_store_links}} s {" ".join(joins)}
          left join {{customer}} c on s.customer_rhid = c.c_custkey
          left join {{nation}} money on c.c_nationkey = money.n_nationkey
          left join {{region}} r on s.region_rhid = r.r_regionkey"""


HIERARCHY = hierarchy_sql()

#: Both sides of the content reconciliation, each distinct line with how often they hold it.
AS_SENT = """sent as (select *, cast(date_trunc('month', l_shipdate) as date) as month from {lineitem}),
        kept as (select * from sent where not (l_quantity = 13 and l_tax < 0.02)),
        arrived as (select * replace (l_quantity + case when l_returnflag = 'R' and l_linenumber = 7 then 1 else 0 end as l_quantity)
          from (select * from kept union all select * from kept where l_quantity = 14 and l_tax < 0.02)),
        compared as (select * exclude (sign), count(*) filter (where sign = 1) as source_rows,
          count(*) filter (where sign = -1) as target_rows
          from (select *, 1 as sign from sent union all select *, -1 as sign from arrived) group by all)"""

ORACLES = {
    "wire_header_strip": """
        with framed as (select event_id,
            '00' || lpad(hex(user_id), 8, '0') || hex(encode(props)) as frame from {v_cdc})
        select event_id, cast('0x' || substr(frame, 3, 8) as bigint) as schema_id,
          decode(unhex(substr(frame, 11))) as payload from framed""",
    "decode_by_writer": """
        with sent as (
          select event_id, user_id, amount, event_type, event_id % 2 = 0 and event_type <> 'signup' as second, event_id % 10 = 0 as unpriced,
            case when event_id % 7 = 0 then 'frame' when event_type = 'error' then 'schema' when event_type = 'signup' then 'payload' end as error,
            case when event_type = 'error' then 9 when event_id % 2 = 0 and event_type <> 'signup' then 2 else 1 end as number,
            '{"event_id":' || event_id || coalesce(',"amount":"' || cast(amount as varchar) || '"', '') || ',"event_type":"' || event_type || '"}' as first,
            '{"data":{"event_id":' || event_id || case when event_id % 10 = 0 then ',"amount":"n/a"' else coalesce(',"amount":"' || cast(amount as varchar) || '"', '') end
              || ',"visitor":' || user_id || '},"event_type":"' || event_type || '"}' as other
          from {v_cdc})
        select event_id as sent, case when error = 'frame' then null else number end as schema_id,
          case when error is null and not second then event_id end as event_id, case when error is null and not second then amount end as amount,
          case when error is null and second then event_id end as inner_id, case when error is null and second and not unpriced then amount end as inner_amount,
          case when error is null then event_type end as event_type,
          case when error is null and second then '{' || case when unpriced then '"data.amount":"\\"n/a\\"",' else '' end || '"data.visitor":"' || user_id || '"}' end as rescued,
          error,
          case when error = 'frame' then 2 when error is not null then 5 + strlen(case when event_type = 'signup' then first[:-2] when second then other else first end) end as raw_bytes
        from sent""",
    "envelope_decode": f"""
        select {", ".join(f"case when event_type <> 'error' then {c} end as {c}" for c in EVENT.split(", "))},
          case when operation = 'UPDATE' then cast(amount + 1 as decimal(20,6)) end as before_amount,
          case when event_type <> 'error' then operation end as operation,
          case when event_type <> 'error' then change_sequence end as change_sequence, ingest_date
        from {{v_cdc}}""",
    "json_value_source": "select event_id, user_id, amount, event_type, ingest_date from {v_cdc}",
    "cdc_flatten": f"select {EVENT}, operation, change_sequence from {{v_cdc}}",
    "cdc_enrich": f"select {EVENT}, {META}, {HEADER}, cast(event_id as varchar) as transaction_id from {{v_cdc}}",
    "cdc_history": f"""
        select {EVENT}, stamp as rec_create_timestamp, 'DL User' as rec_create_user_name,
          stamp as rec_update_timestamp, 'DL User' as rec_update_user_name,
          {day_key("stamp")} as rec_create_date_key,
          case when operation = 'REFRESH' then 120000 else cast(strftime(stamp, '%H%M') as int) end
            as rec_create_time_key,
          operation as rec_crud_text, cast(operation = 'DELETE' as int) as delete_ind,
          cast(null as int) as exception_ind, cast(null as int) as resolved_ind
        from (select *, case when operation = 'REFRESH' then cast(ingest_date as timestamp) else hdr_timestamp end
            as stamp from {{v_cdc}}) x""",
    "pii_mask": """
        select sha256(cast(user_id as varchar)) as user_id, event_id, event_type, amount, sha256(props) as props,
          event_ts,
          case when operation in ('UPDATE', 'DELETE') then sha256(cast(user_id as varchar)) end as before_user_id,
          case when operation in ('UPDATE', 'DELETE') then sha256(props) end as before_props,
          case when operation in ('UPDATE', 'DELETE') then cast(amount + 1 as decimal(20,6)) end as before_amount
        from {v_cdc}""",
    "epoch_to_timestamp": "select event_id, date_trunc('second', event_ts) as happened from {v_cdc}",
    "row_hash": """
        with r as (select *, nullif(event_type, 'view') as code from {v_cdc})
        select event_id, sha256(concat_ws('||', user_id, code, amount, ingest_date)) as rec_row_hash,
          sha256(concat_ws('||', '1' || user_id, coalesce('1' || code, '0'), '1' || amount, '1' || ingest_date))
            as rec_row_hash_null_safe
        from r""",
    "pk_hash": """
        with r as (select *, nullif(event_type, 'view') as code from {v_cdc})
        select event_id, sha256(concat_ws('||', user_id, code, operation)) as rec_pk_hash,
          sha256(concat_ws('||', user_id, code)) as rec_pk_hash_append
        from r""",
    "csv_to_cdc": """
        select event_id, event_ts as cdc_timestamp_raw, substr(operation, 1, 1) as flag,
          operation = 'DELETE' as cdc_deleted
        from {v_cdc}""",
    "conform_types": """
        select event_id + 3000000000 as event_id, amount, event_ts, ingest_date,
          case when event_type <> 'click' then cast(user_id as int) end as user_id, event_type,
          case when event_type = 'click' then 'user_id' else '' end as failed_columns
        from {v_cdc}""",
    "widen_decimals": """
        select event_id, cast(cast(amount as decimal(10,2)) as decimal(20,6)) as amount,
          cast(cast(amount as decimal(18,4)) as decimal(20,6)) as half from {v_cdc}""",
    "scalar_functions": f"""
        with r as (select *, case when event_type <> 'view' then event_type end as code from {{v_cdc}})
        select event_id, coalesce(code, 'none') as nvl_text,
          case when amount > 100 then 'high' when amount > 10 then 'middle' else 'low' end as band,
          code || '_' || user_id as joined, concat_ws('||', code, props) as joined_ws,
          substr(event_type, 2, 3) as middle_text, left(event_type, 3) as left_text,
          cast(replace(cast(ingest_date as varchar), '-', '') as int) as day_digits,
          cast(octet_length(encode(props)) as int) as bytes, sha256(props) as digest,
          {day_key("event_ts")} as date_key, cast(strftime(event_ts, '%H%M') as int) as minute_key,
          cast(strftime(event_ts, '%H%M%S') as int) as second_key, cast(event_ts as date) as day,
          date '1900-01-01' as first_day, {utc("event_ts")} as utc,
          date_trunc('minute', event_ts) as half_day_clock, date_trunc('second', event_ts) as from_millis,
          cast(amount + 1 as decimal(20,6)) as plus, cast(amount as decimal(20,2)) as cents,
          cast(floor(amount) as int) as whole, cast(null as int) as nothing, user_id as nested_user,
          cast(regexp_extract(props, '[0-9]+') as int) as k
        from r""",
    "cdc_latest": f"""
        with {FLAT}
        select {EVENT}, {", ".join(META_NAMES)}, "changeSequence",
          sha256(concat_ws('||', user_id, event_id, event_type, amount, props)) as rec_row_hash,
          sha256(concat_ws('||', user_id, rec_crud_text)) as rec_pk_hash
        from (select *, row_number() over (partition by user_id
          order by "changeSequence" desc, hdr_timestamp desc, event_id desc) as rn from flat) x where rn = 1""",
    "dq_null_check": f"""
        with {INCOMPLETE}, ruled as (select *, {null_rule("user_id rec_crud_text")} as rule_name from rows)
        select * replace (case when rule_name is not null then 1 end as exception_ind) from ruled""",
    "dq_duplicates": f"""
        with {FLAT}, rows as (select *, cast(event_ts as date) as slot from flat), {ranked("user_id, slot")},
        dup as (select distinct user_id, slot, rec_crud_text from ranked where _rank > 1)
        select r.event_id, r.user_id, r.slot, r.rec_crud_text from ranked r join dup d
          on r.user_id = d.user_id and r.slot = d.slot and r.rec_crud_text = d.rec_crud_text""",
    "dq_exceptions": f"""
        with {INCOMPLETE.replace("rows as", "holes as")},
        rows as (select *, cast(hdr_timestamp as date) as slot from holes), {ranked("user_id, slot")},
        dup as (select distinct user_id, slot, rec_crud_text from ranked where _rank > 1),
        bad as (
          select 'DuplicateCheck' as rule_name, r.* from rows r join dup d on r.user_id is not distinct from d.user_id
            and r.slot = d.slot and r.rec_crud_text = d.rec_crud_text
          union all
          select rule_name, * exclude (rule_name) from
            (select *, {null_rule("user_id slot rec_crud_text")} as rule_name from rows) n where rule_name is not null)
        select rule_name, user_id, event_id, props, amount, rec_create_date_key, rec_crud_text, 1 as exception_ind, slot,
          sha256(concat_ws('||', user_id, event_id, props)) as rec_row_hash,
          sha256(concat_ws('||', user_id, slot, rec_crud_text)) as rec_pk_hash from bad""",
    "merge_upsert": merge_sql("early", "late", True),
    "merge_reload": RELOAD,
    "merge_rebucket": merge_sql("early", "late", True),
    "merge_bucketed_table": merge_sql("late", "early", True),
    "merge_out_of_order": merge_sql("late", "early", True),
    "merge_unguarded": merge_sql("late", "early", False),
    "distinct_lines": "select distinct l_orderkey, l_linenumber, l_returnflag from {lineitem}",
    "incremental_filter": """
        select event_id, user_id, ts as rec_update_timestamp from {events}
        where ts > coalesce((select max(src_last_upd_timestamp) from {v_audit}
          where jobname = 'load purchase' and load_status = 'COMPLETED'), timestamp '1900-01-01 00:00:00')""",
    "audit_watermark": """
        select jobname, coalesce(max(case when load_status = 'COMPLETED' then src_last_upd_timestamp end),
          timestamp '1900-01-01 00:00:00') as watermark from {v_audit} group by jobname""",
    "audit_complete": f"""
        with {ROW_STATE},
        newest as (select jobname, max(rec_create_timestamp) as since from state where load_status is null group by 1),
        marked as (select s.*, n.since is not null as closing from state s left join newest n
          on s.jobname = n.jobname and s.rec_create_timestamp = n.since and s.load_status is null)
        select jobname, src_last_upd_timestamp, case when closing then 'COMPLETED' else load_status end as load_status,
          rec_create_timestamp, rec_create_user_name,
          case when closing then {NOW} else rec_update_timestamp end as rec_update_timestamp,
          case when closing then jobname else rec_update_user_name end as rec_update_user_name from marked""",
    "upstream_ready": """
        with runs as (select jobname, rec_create_timestamp as created, load_status from {v_audit}
          union all select 'user ' || user_id, event_ts, case when operation = 'UPDATE' then 'COMPLETED' end from {v_cdc}),
        newest as (select *, row_number() over (partition by jobname order by created desc) as rn from runs
          where created >= timestamp '2024-01-10 00:00:00')
        select jobname, load_status is not distinct from 'COMPLETED' as ready from newest where rn = 1""",
    "reconcile_counts": f"""
        with {HUBS}, daily as ({visits_sql("{v_traffic}")})
        select (select count(*) from (select distinct store_number, visit_date from {{v_traffic}}) g)
            as input_row_count,
          count(*) as output_row_count, max(visit_date) as last_visit_date from daily where store_rhid > 0""",
    "reconcile_contents": f"""
        with {AS_SENT} select l_suppkey, month, cast(sum(source_rows) as bigint) as source_rows,
          cast(sum(target_rows) as bigint) as target_rows from compared group by l_suppkey, month
        having count(*) filter (where source_rows <> target_rows) > 0""",
    "reconcile_rows": f"with {AS_SENT} select * from compared where source_rows <> target_rows",
    "hub_lookup_store": STORE_HUB,
    "hub_lookup_product": PRODUCT_HUB,
    "hub_lookup_currency": CURRENCY_HUB,
    "hub_overlap_check": f"""
        with {HUBS}, rounded as (select * replace (case when year(effective_end_timestamp) < 2099
            then date_trunc('day', effective_end_timestamp) + interval 1 day else effective_end_timestamp end
            as effective_end_timestamp) from store_hub)
        select source_system_natural_key, store_rhid, effective_end_timestamp, next_start_timestamp
        from (select *, lead(effective_start_timestamp) over (partition by source_system_natural_key
            order by effective_start_timestamp, effective_end_timestamp) as next_start_timestamp from rounded) x
        where next_start_timestamp <= effective_end_timestamp""",
    "asof_store_join": asof(
        "store_hub", "store_num", {"store_rhid": "store_rhid", "store_grpid": "store_grpid"}, "o"),
    "asof_store_sweep": asof(
        "store_hub", "store_num", {"store_rhid": "store_rhid", "store_grpid": "store_grpid"}, "o"),
    "asof_ship_store_join": asof(
        "store_hub", "ship_store_num", {"store_rhid": "ship_store_rhid", "store_grpid": "ship_store_grpid"}, "i"),
    "asof_currency_join": asof(
        "currency_hub", "currency_code",
        {"currency_rhid": "currency_rhid", "currency_grpid": "currency_grpid"}, "o"),
    "asof_product_join": asof(
        "product_hub", "sku_number", {"product_rhid": "product_rhid", "product_grpid": "product_grpid"}, "i", "<"),
    "null_safe_join": """
        with totals as (select store_rhid, order_date_key, cast(sum(sales_qty) as bigint) as store_day_qty
          from {v_fact} group by 1, 2)
        select f.order_id, f.store_rhid, f.order_date_key, f.sales_qty, t.store_day_qty from {v_fact} f join totals t
          on coalesce(cast(f.store_rhid as varchar), '*') = coalesce(cast(t.store_rhid as varchar), '*')
          and f.order_date_key = t.order_date_key""",
    "dimension_flatten": """
        select s_suppkey, s_name, s_nationkey, n_name as nation_n_name, n_regionkey as nation_n_regionkey,
          r_name as region_r_name, currency_grpid as currency_code
        from {supplier} left join {nation} on s_nationkey = n_nationkey
          left join {region} on n_regionkey = r_regionkey
          left join {v_mst_currency} on s_nationkey = currency_rhid""",
    "ecom_sales_detail": ECOM,
    "ecom_sales_by_branch": ECOM,
    "retail_sales_detail": RETAIL_KEYED,
    "retail_sales_per_line": RETAIL_LINE,
    "store_visits_daily": f"with {HUBS} {visits_sql('{v_traffic}')}",
    "store_visits_merge": VISITS_MERGE,
    "gold_store_metrics_as_written": metrics_sql(per_day=False),
    "gold_store_metrics_per_day": metrics_sql(per_day=True),
    "stream_ingest_ct": """
        select sha256(cast(user_id as varchar)) as user_id, event_id, event_type, amount, sha256(props) as props,
          event_ts, case when operation in ('UPDATE', 'DELETE') then sha256(props) end as before_props,
          operation, change_sequence, ingest_date from {v_cdc}""",
    "stream_ct_to_current": LATEST,
    "stream_exceptions": f"""
        with {FLAT}, rows as (select * from flat), {ranked("user_id, event_type")},
        dup as (select distinct user_id, event_type, rec_crud_text from ranked where _rank > 1)
        select 'DuplicateCheck' as rule_name,
          r.* exclude ("changeSequence", hdr_timestamp) replace (1 as exception_ind),
          {WHOLE_ROW.format("r.")} as rec_row_hash,
          sha256(concat_ws('||', r.user_id, r.event_type, r.rec_crud_text)) as rec_pk_hash
        from rows r join dup d on r.user_id = d.user_id and r.event_type = d.event_type
          and r.rec_crud_text = d.rec_crud_text""",
    "stream_append_current": f"""
        with {FLAT} select {EVENT}, {", ".join(META_NAMES)},
          {WHOLE_ROW.format("")} as rec_row_hash,
          sha256(cast(user_id as varchar)) as rec_pk_hash from flat""",
    "stream_csv_source": FEED,
    "stream_json_source": FEED,
    "stream_table_source": f"select {EVENT}, operation, ingest_date from {{v_cdc}}",
    "stream_json_value_source": f"select {EVENT}, operation, ingest_date from {{v_cdc}}",
    "stream_flat_feed_to_current": """
        select user_id, event_id, amount, rec_crud_text, cast(rec_crud_text = 'DELETE' as int) as delete_ind
        from (select *, operation as rec_crud_text, row_number() over (partition by user_id
          order by (operation = 'REFRESH'), event_ts desc, event_id desc) as rn from {v_cdc}) x where rn = 1""",
    "stream_progress_log": "select 'progress' as name, count(*) as num_input_rows from {events}",
    "stream_rule_counts": """
        with broken as (select coalesce(cast(user_id as varchar), '') = '' or user_id % 7 = 0 as pk,
          props is null or props = '' or amount > 50 or coalesce(event_type, '') = '' as gap from {v_cdc})
        select 'NullCheckForPKs' as rule_name, count(*) filter (pk) as failures from broken
        union all select 'NullCheckForNotNullCols', count(*) filter (not pk and gap) from broken""",
    "audit_run_log": """
        select 'logged' as job_name, 'KAFKA' as source_type, 'events' as source_name, 'TABLE' as sink_type,
          'DL User' as rec_create_user_name, count(*) as input_row_count, count(*) as output_row_count,
          0 as exception_ind from {events}""",
    "incremental_load": """
        select 'loader' as jobname, max(event_ts) as src_last_upd_timestamp, 'COMPLETED' as load_status,
          case when event_ts < timestamp '2024-01-16 00:00:00' then timestamp '2024-02-01 00:00:00'
            else timestamp '2024-02-02 00:00:00' end as rec_create_timestamp, count(*) as loaded_rows
        from {v_cdc} group by 4""",
    "load_store_visits": f"""
        select * replace (cast(entry_count as int) as entry_count, cast(exit_count as int) as exit_count)
        from ({VISITS_MERGE.replace("'first'", "'visits'").replace("'second'", "'visits'")}) m""",
    "gold_two_loads": gold_end_to_end(per_day=True, items="{v_changed_items}"),
    "gold_moved_days": gold_end_to_end(per_day=True, items="{v_resent_items}", order_log="{v_moved_log}"),
    "load_run_log": f"""
        with {HUBS}, daily as ({visits_sql("{v_traffic}")}), counts as (
          select (select count(*) from {{v_traffic}}) as rows_in, (select count(*) from daily) as rows_out)
        select 'visits' as job_name, 'TABLE' as source_type, 'events' as source_name,
          'slv_retail_sales.agg_store_visits_daily' as sink_name,
          case d when 1 then rows_in else 0 end as input_row_count, case d when 1 then rows_out else 0 end as output_row_count,
          0 as exception_ind, timestamp '2024-01-31 00:00:00' + d * interval 1 day as rec_create_timestamp
        from counts, (values (1), (2)) v(d)""",
    "store_hierarchy": HIERARCHY,
    "schema_from_json": FEED,
    "schema_from_avro_document": FEED,
    "configured_job": LATEST,
    "staged_overwrite": "select event_id, user_id, event_type from {events} where event_type <> 'view'",
    "create_table_as_select": """
        select visit_date_key, cast(sum(entries) as bigint) as entries from {v_traffic} group by 1""",
    "typed_target_table": f"""
        with {HUBS} select visit_date_key, store_rhid, visit_date, cast(entry_count as int) as entry_count,
          cast(exit_count as int) as exit_count, 'nightly' as rec_create_user_name
        from ({visits_sql("{v_traffic}")}) d""",
    "stream_restart": f"select {EVENT}, operation, ingest_date from {{v_cdc}}",
    "compact_day": f"select {EVENT}, operation, ingest_date, ingest_date = min(ingest_date) over () as compacted from {{v_cdc}}",
    "gold_end_to_end": gold_end_to_end(),
    "merge_keyed_table": merge_sql("late", "early", True),
    "sql_job_append_overwrite": """
        select event_type, count(*) as n, max(value) as top from {events} where user_id >= 0 group by 1
        union all select event_type, count(*), max(value) from {events} where user_id >= 10 group by 1""",
    "sql_script_run": """
        with daily as (select store_number, visit_date, cast(sum(entries) as bigint) as entries from {v_traffic}
          group by 1, 2), busy as (select * from daily where entries > 100)
        select *, 'nightly' as loaded_by, (select count(*) from {v_traffic}) as input_rows,
          (select count(*) from busy) as output_rows from busy""",
}


def all_oracles() -> dict[str, str]:
    return {name: duck(text) for name, text in ORACLES.items()}
