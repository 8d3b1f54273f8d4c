"""Oracle SQL: each registered query once more, for DuckDB over the same tables.

Division of decimals is floating point there, so money ratios are computed in
whole numbers, rounded half up.
"""

from __future__ import annotations

import re

from checks import feeds

# Building blocks, each free to use the ones above it.
_BLOCKS: dict[str, str] = {
    "pos": feeds.oracle_feed(feeds.POS),
    "erp": feeds.oracle_feed(feeds.ERP),
    "iot": feeds.oracle_feed(feeds.IOT),
    "s_pos": """
select transaction_id, store_id, store_name, store_city, store_region, cashier_id, customer_id,
  transaction_date, transaction_time, product_sku, product_name, upper(category) as category,
  subcategory,
  cast(case when quantity > 0 then quantity else 0 end as int) as quantity,
  cast(case when unit_price > 0 then unit_price else 0 end as decimal(18,2)) as unit_price,
  cast(case when discount_pct >= 0 then discount_pct else 0 end as int) as discount_pct,
  total_amount,
  case upper(payment_method) when 'CREDIT CARD' then 'CC' when 'DEBIT CARD' then 'DC'
       else payment_method end as payment_method,
  loyalty_points,
  cast(cast(transaction_date as string) || ' ' || transaction_time as timestamp) as transaction_ts,
  cast(0 as double) as line_total
from pos""",
    "s_erp": """
select order_id, cast(order_date as date) as order_date, store_id, store_city, supplier_id,
  supplier_name, supplier_city, product_sku, upper(category) as category, quantity_ordered,
  quantity_received, cast(unit_cost as decimal(12,2)) as unit_cost,
  cast(total_cost as decimal(14,2)) as total_cost, upper(order_status) as order_status,
  cast(expected_delivery as date) as expected_delivery,
  cast(actual_delivery as date) as actual_delivery, warehouse_id, lead_time_days, is_late
from erp""",
    "s_sensor": """
select event_id, event_type, store_id, store_name, events_ts, device_id,
  json_extract_string(raw_payload, '$.metadata.firmware') as firmware,
  cast(json_extract_string(raw_payload, '$.metadata.battery_pct') as int) as battery_pct,
  cast(json_extract_string(raw_payload, '$.metadata.signal_rssi') as int) as signal_rssi,
  cast(json_extract_string(raw_payload, '$.metadata.store_floor') as int) as store_floor_sensor,
  json_extract_string(reading, '$.sensor') as sensor,
  cast(json_extract_string(reading, '$.value') as double) as sensor_value,
  json_extract_string(reading, '$.unit') as sensor_unit
from (select *, unnest(json_extract(raw_payload, '$.readings[*]')) as reading from iot)""",
    "d_date": """
select cast(strftime(day, '%Y%m%d') as int) as date_key, day as full_date,
  cast(extract(day from day) as int) as day_of_month, strftime(day, '%a') as day_name,
  cast(extract(week from day) as int) as week_of_year,
  cast(extract(month from day) as int) as month_number, strftime(day, '%b') as month_name,
  cast(extract(quarter from day) as int) as quarter_number,
  cast(extract(year from day) as int) as year_number
from (select transaction_date as day from s_pos union select order_date from s_erp
      union select cast(events_ts as date) from s_sensor)
where day is not null""",
    "seen_stores": """
select store_id, store_name, store_city, store_region, cast(null as int) as store_floor_sensor
from s_pos where store_id is not null
union
select store_id, store_name, null, null, store_floor_sensor
from s_sensor where store_id is not null""",
    "d_store": """
select row_number() over (order by store_id) as store_key, store_id, store_name, store_city,
  store_region, cast(store_floor_sensor as bigint) as store_floor_sensor
from (select * from seen_stores qualify row_number() over (partition by store_id
        order by store_name nulls last, store_city nulls last, store_region nulls last,
                 store_floor_sensor nulls last) = 1)""",
    "d_store_both": """
select store_key, d.store_id, store_name, store_city, store_region,
  (select cast(min(f.store_floor_sensor) as bigint) from seen_stores f
   where f.store_id = d.store_id) as store_floor_sensor
from d_store d""",
    "d_product": """
select row_number() over (order by product_sku) as product_key, product_sku, product_name,
  category, subcategory
from (select distinct product_sku, product_name, category, subcategory from s_pos
      where product_sku is not null
      qualify row_number() over (partition by product_sku
        order by product_name nulls last, category nulls last, subcategory nulls last) = 1)""",
    "d_customer": """
select row_number() over (order by customer_id) as customer_key, customer_id
from (select distinct customer_id from s_pos where customer_id is not null)""",
    "d_supplier": """
select row_number() over (order by supplier_id) as supplier_key, supplier_id, supplier_name,
  supplier_city
from (select distinct supplier_id, supplier_name, supplier_city from s_erp
      where supplier_id is not null
      qualify row_number() over (partition by supplier_id
        order by supplier_name nulls last, supplier_city nulls last) = 1)""",
    "f_sales": """
select transaction_id, cast(strftime(transaction_date, '%Y%m%d') as int) as date_key, store_key,
  product_key, customer_key, transaction_date, transaction_ts,
  cast(quantity as bigint) as quantity, unit_price,
  cast(discount_pct as decimal(10,2)) as discount_pct,
  cast(quantity * unit_price as decimal(18,2)) as gross_amount,
  cast(quantity * unit_price * discount_pct * 0.01 as decimal(18,2)) as discount_amount,
  total_amount as net_sales_amount, payment_method,
  cast(loyalty_points as bigint) as loyalty_points
from s_pos left join d_store using (store_id) left join d_product using (product_sku)
  left join d_customer using (customer_id)""",
    "f_daily": """
select transaction_date as sales_date, store_key, s_pos.category,
  cast(sum(total_amount) as decimal(18,2)) as total_revenue,
  cast(sum(quantity) as bigint) as total_units,
  count(distinct transaction_id) as transaction_count,
  count(distinct customer_id) as customer_count,
  cast(((2 * cast(sum(total_amount) * 100 as hugeint) + count(distinct transaction_id))
        // (2 * count(distinct transaction_id))) as decimal(18,0)) * cast(0.01 as decimal(3,2))
    as avg_basket
from s_pos join d_store using (store_id)
group by transaction_date, store_key, s_pos.category""",
    "f_orders": """
select order_id, cast(strftime(order_date, '%Y%m%d') as int) as date_key, store_key,
  supplier_key, order_date, category, product_sku, quantity_ordered, quantity_received,
  cast(unit_cost as decimal(18,2)) as unit_cost, cast(total_cost as decimal(18,2)) as total_cost,
  order_status, expected_delivery, actual_delivery, warehouse_id, lead_time_days, is_late
from s_erp left join d_store using (store_id) left join d_supplier using (supplier_id)""",
    "f_margin": """
select margin_date, store_key, category, sales_revenue, procurement_cost,
  cast(sales_revenue - procurement_cost as decimal(18,2)) as gross_margin,
  cast(case when sales_revenue = 0 then 0
       else (sales_revenue - procurement_cost) / sales_revenue * 100 end as decimal(10,2))
    as gross_margin_pct,
  sales_units, ordered_units, received_units, late_order_count
from (
  select s.*, d.store_key, cast(coalesce(cost, 0) as decimal(18,2)) as procurement_cost,
    coalesce(ordered, 0) as ordered_units, coalesce(received, 0) as received_units,
    coalesce(late, 0) as late_order_count
  from (select transaction_date as margin_date, store_id, category,
          cast(sum(total_amount) as decimal(18,2)) as sales_revenue,
          cast(sum(quantity) as bigint) as sales_units
        from s_pos group by all) s
    join d_store d on s.store_id = d.store_id
    left join (select order_date, store_id, category, sum(total_cost) as cost,
          cast(sum(quantity_ordered) as bigint) as ordered,
          cast(sum(quantity_received) as bigint) as received,
          count(*) filter (is_late) as late
        from s_erp group by all) o
      on s.margin_date = o.order_date and s.store_id = o.store_id and s.category = o.category)""",
    "f_iot": """
select event_id, cast(strftime(events_ts, '%Y%m%d') as int) as date_key, store_key, event_type,
  device_id, events_ts, sensor, cast(sensor_value as decimal(18,4)) as sensor_value, sensor_unit,
  firmware, cast(battery_pct as bigint) as battery_pct, cast(signal_rssi as bigint) as signal_rssi,
  cast(s_sensor.store_floor_sensor as bigint) as store_floor_sensor
from s_sensor left join d_store using (store_id)""",
    "old_state": "select * from orders where o_orderpriority <> '5-LOW'",
    "new_state": """
select * replace (case when o_orderpriority = '2-HIGH' then o_totalprice + 1
                       else o_totalprice end as o_totalprice)
from orders where o_orderpriority <> '1-URGENT'""",
}


def _used(text: str) -> set[str]:
    """Blocks that ``text`` needs, directly or through other blocks."""
    direct = {name for name in _BLOCKS if re.search(rf"\b{name}\b", text)}
    return direct.union(*(_used(_BLOCKS[name]) for name in direct if _BLOCKS[name] != text))


def _query(text: str) -> str:
    needed = _used(text)
    blocks = [f"{name} as ({sql})" for name, sql in _BLOCKS.items() if name in needed]
    return f"with {', '.join(blocks)} {text}" if blocks else text


def _counts(names: dict[str, str]) -> str:
    return _query(
        " union all ".join(
            f"select '{label}' as object_name, count(*) as row_count from {block}"
            for label, block in names.items()
        )
    )


_DIM_BLOCKS = {
    "DIM_DATE": "d_date",
    "DIM_STORE": "d_store",
    "DIM_PRODUCT": "d_product",
    "DIM_CUSTOMER": "d_customer",
    "DIM_SUPPLIER": "d_supplier",
}
_FACT_BLOCKS = {
    "FCT_SALES": "f_sales",
    "FCT_DAILY_SALES": "f_daily",
    "FCT_PURCHASE_ORDERS": "f_orders",
    "FCT_STORE_CATEGORY_MARGIN": "f_margin",
    "FCT_IOT_SENSOR_READINGS": "f_iot",
}
_MERGED = "select * from new_state"
_SALES = "select * from f_sales"

ORACLE: dict[str, str] = {
    "margin": _query("select * from f_margin"),
    "daily_sales": _query("select * exclude (avg_basket), avg_basket as avg_basket_size from f_daily"),
    "sales": _query(_SALES),
    "sales_shuffled": _query(_SALES),
    "sales_numbered": _query(
        "select row_number() over (order by transaction_id nulls last, date_key nulls last, "
        "store_key nulls last, product_key nulls last, customer_key nulls last, "
        "transaction_date nulls last, transaction_ts nulls last, quantity nulls last, "
        "unit_price nulls last, discount_pct nulls last, gross_amount nulls last, "
        "discount_amount nulls last, net_sales_amount nulls last, payment_method nulls last, "
        "loyalty_points nulls last) as sales_key, * from f_sales"
    ),
    "purchase_orders": _query("select * from f_orders"),
    "iot_readings": _query("select * from f_iot"),
    "fact_keys": _query(
        "select 'sales_key' as key_name, count(*) as row_count, count(*) as key_count from s_pos "
        "union all select 'order_key', count(*), count(*) from s_erp "
        "union all select 'sensor_reading_key', count(*), count(*) from s_sensor"
    ),
    "silver_pos": _query("select * from s_pos"),
    "silver_erp": _query("select * from s_erp"),
    "silver_sensor": _query("select * from s_sensor"),
    "dim_date": _query("select * from d_date"),
    "dim_store": _query("select * from d_store"),
    "dim_store_both_sources": _query("select * from d_store_both"),
    "dim_product": _query("select * from d_product"),
    "dim_customer": _query("select * from d_customer"),
    "dim_supplier": _query("select * from d_supplier"),
    "validate_dims": _counts(_DIM_BLOCKS),
    "validate_facts": _counts(_FACT_BLOCKS),
    "lakehouse": _counts(_DIM_BLOCKS | _FACT_BLOCKS),
    "expected_count": _query(
        "select count(*) as row_count, cast(45000 as bigint) as expected_count, "
        "count(*) = 45000 as as_expected from s_erp"
    ),
    "change_feed": _query(
        "select o.*, 'DELETE' as action, n.o_orderkey is not null as is_update "
        "from old_state o left join new_state n using (o_orderkey) "
        "where n.o_orderkey is null or n.o_totalprice <> o.o_totalprice "
        "union all "
        "select n.*, 'INSERT', o.o_orderkey is not null "
        "from new_state n left join old_state o using (o_orderkey) "
        "where o.o_orderkey is null or n.o_totalprice <> o.o_totalprice"
    ),
    "merge_full": _query(_MERGED),
    "merge_shuffled": _query(_MERGED),
    "merge_append": (
        "select * replace (case when o_orderpriority = '5-LOW' then o_totalprice + 1 "
        "else o_totalprice end as o_totalprice) from orders"
    ),
    "merge_table": _query(_MERGED),
    "replace_table": _query(
        "select 'before' as state, * from old_state union all select 'after', * from new_state "
        "union all select 'before again', * from old_state"
    ),
    "compaction": _query("select * from s_pos"),
    "change_feed_payload": _query("""
, payload_rows as (
  select case when cast(event_id as bigint) % 5 > 0 then store_id end as store_id, event_id, event_type, raw_payload from iot),
old_rows as (select store_id, event_id, event_type, raw_payload from payload_rows where event_type <> 'click'),
new_rows as (
  select store_id, event_id, event_type,
    case when cast(event_id as bigint) % 7 = 0 then replace(raw_payload, '"firmware"', '"release"') else raw_payload end as raw_payload
  from payload_rows where event_type <> 'view'),
changed as (
  select 'DELETE' as action, * from (select * from old_rows except all select * from new_rows)
  union all select 'INSERT', * from (select * from new_rows except all select * from old_rows)),
per_store as (
  select store_id, count(*) filter (action = 'DELETE') as gone, count(*) filter (action = 'INSERT') as came from changed group by store_id),
updates as (
  select store_id, action, case action when 'DELETE' then gone else came end as n,
    case when store_id is null then 0 else least(gone, came) end as pairs
  from per_store, (values ('DELETE'), ('INSERT')) a(action))
select 'event_id' as counted_by, event_id as id, coalesce(json_extract_string(raw_payload, '$.release'), '-') as detail, action,
  count(*) as row_count
from changed group by event_id, detail, action
union all select 'store_id', store_id, 'true', action, pairs from updates where pairs > 0
union all select 'store_id', store_id, 'false', action, n - pairs from updates where n > pairs"""),
    "bronze_pos": _query("select * from pos"),
    "bronze_iot": _query("select * exclude (raw_payload) from iot"),
    "bronze_events": _query(
        "select event_id, json_extract_string(raw_payload, '$.metadata.firmware') as firmware, "
        "cast(json_extract_string(raw_payload, '$.readings[1].value') as bigint) as second_value "
        "from iot"
    ),
    "bronze_erp": _query("select * from erp"),
    "stream_pos": _query("select * from s_pos"),
    "stream_iot": _query("select * from s_sensor"),
    "stream_erp": _query("select * from s_erp"),
    "handover": _query(
        "select * replace (case when cast(transaction_id as bigint) % 11 > 0 "
        "then transaction_id end as transaction_id) from s_pos"
    ),
    "file_selection": _query(
        "select case store_region when 'ASIA' then 'prefix' else 'list' end as selected, * from pos "
        "where store_region in ('ASIA', 'EUROPE')"
    ),
    "load_list_twice": _query("select * from pos where store_region in ('ASIA', 'EUROPE', 'AFRICA')"),
    "csv_edges": (
        "select cast(event_id as varchar) as event_id, cast(date_trunc('second', ts) as timestamp) as event_ts, "
        "cast(ts as date) as event_day, case when event_id % 6 > 3 then cast(value as decimal(18,4)) end as amount from events"
    ),
    "json_documents": _query("select * exclude (raw_payload) from iot"),
    "json_large_arrays": _query(
        "select * exclude (raw_payload), json_extract_string(raw_payload, '$.metadata.firmware') as firmware, "
        "cast(json_extract_string(raw_payload, '$.readings[1].value') as bigint) as second_value from iot"
    ),
    "audit_columns": _query(
        "select event_id as row_id, 'sensor-feed' as origin, '2024-05-06 07:08:09' as written from iot "
        "union all select store_id, 'dim_store', '2024-05-06 07:08:09' from d_store"
    ),
}
