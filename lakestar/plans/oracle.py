"""DuckDB oracle SQL for every registered query (the acceptance queries).

``{NAME}`` is a named fragment substituted textually.  Keys in these
queries are ``row_number()`` over the natural key, which the Spark side
computes with range buckets (no single-task window).
"""

from __future__ import annotations

FRAGMENTS = {
    "LATEST": "(select * from (select l.*, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc, l_quantity desc, l_discount desc, l_tax desc) as rn from lineitem l) x where rn = 1)",
    "RESULT": "(select l_orderkey * 10 + l_linenumber as result_id, l_orderkey as race_id, l_suppkey as constructor_id, concat(l_returnflag, l_linestatus) as status_name, l_linenumber as position_order, l_quantity as points, l_linestatus from {LATEST} y)",
    "RACEKEY": "(select o_orderkey, o_custkey, row_number() over (order by o_orderkey) as race_key from orders)",
    "DRIVERKEY": "(select c_custkey, row_number() over (order by c_custkey) as driver_key from customer)",
    "CONSKEY": "(select s_suppkey, row_number() over (order by s_suppkey) as constructor_key from supplier)",
    "STATUSKEY": "(select status_name, row_number() over (order by status_name) as status_key from (select distinct concat(l_returnflag, l_linestatus) as status_name from lineitem) z)",
    "REPORT": "(select cr.result_key, cr.race_type, cast(year(o.o_orderdate) as bigint) as race_year, cast(o.o_orderdate as date) as race_date, n.n_name as circuit_name, r.r_name as circuit_country, c.c_name as driver_fullname, s.s_name as constructor_name, cr.status_name, cr.position_order, cr.points, cr.race_id from (select result_id as result_key, race_id, constructor_id, 'full_race' as race_type, position_order, points, status_name from {RESULT} a where l_linestatus = 'F' union all select result_id as result_key, race_id, constructor_id, 'sprint' as race_type, position_order, points, status_name from {RESULT} b where l_linestatus = 'O') cr left join orders o on cr.race_id = o.o_orderkey left join customer c on o.o_custkey = c.c_custkey left join nation n on c.c_nationkey = n.n_nationkey left join region r on n.n_regionkey = r.r_regionkey left join supplier s on cr.constructor_id = s.s_suppkey)",
    "DSTAND": "(select race_year, competitor, total_points, wins, cast(rank() over (partition by race_year order by total_points desc, wins desc) as bigint) as season_rank from (select race_year, driver_fullname as competitor, cast(sum(points) as decimal(18,2)) as total_points, cast(sum(case when position_order = 1 and race_type = 'full_race' then 1 else 0 end) as bigint) as wins from {REPORT} p group by race_year, driver_fullname) t)",
    "CSTAND": "(select race_year, competitor, total_points, wins, cast(rank() over (partition by race_year order by total_points desc, wins desc) as bigint) as season_rank from (select race_year, constructor_name as competitor, cast(sum(points) as decimal(18,2)) as total_points, cast(sum(case when position_order = 1 and race_type = 'full_race' then 1 else 0 end) as bigint) as wins from {REPORT} p group by race_year, constructor_name) t)",
    "STR": "varchar",
    "TSN": "timestamp",
}

_UPSERT_CTE = "with t as (select c_custkey, c_name, c_acctbal from customer where c_custkey % 3 <> 0), n as (select c_custkey, concat(c_name, '_v2') as c_name, case when c_custkey % 5 = 0 then null else c_acctbal end as c_acctbal from customer where c_custkey % 2 = 0 or c_custkey % 3 = 0)"
_EV_OLD = "(select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events where ts < timestamp '2024-01-29 00:00:00') q where rn = 1)"
_EV_NEW = "(select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events where ts >= timestamp '2024-01-29 00:00:00') q where rn = 1)"
_COUNTRY_RACES = "select r_name as circuit_country, count(distinct o_orderkey) as races from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name"

RAW = {
    "bronze_flatten": "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders",
    "incremental_batch": "select event_id, ts from events where ts > timestamp '2024-01-15 00:00:00'",
    "full_refresh": "select n_nationkey, n_name, n_regionkey from nation",
    "save_roundtrip": "select p_partkey, p_name, p_size from part",
    "load_or_upsert": "select s_suppkey, s_name from supplier",
    "bronze_quarantine": "select o_orderkey, o_custkey, o_totalprice, cast(null as {STR}) as reason, 1::bigint as n from orders where o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0 union all select null, null, null, reason, count(*) from (select case when o_orderkey % 11 = 0 then 'malformed' when o_orderkey % 13 = 0 then 'mistyped' else 'missing' end as reason from orders where o_orderkey % 11 = 0 or o_orderkey % 13 = 0 or o_orderkey % 17 = 0) group by reason",
    "incremental_late_commit": "select event_id, ts, user_id from events",
    "upsert_two_writers": "select count(*) as n_rows, count(*) as n_keys, 1 as low, count(*) as high, cast(sum(case when s_suppkey % 3 = 0 then 1 else 0 end) as bigint) as n_old from supplier",
    "upsert_partitions": "select o_orderkey, o_custkey, case when o_orderkey <= 8 then o_totalprice + 1 else o_totalprice end as o_totalprice, true as few_written from orders",
    "rename_project": "select c_custkey as driver_id, c_name as driver_ref, c_mktsegment as driver_team from customer",
    "dedup_latest": "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from {LATEST} t",
    "dedup_latest_events": "select event_id, user_id, ts, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t where rn = 1",
    "sentinel_cast": "select c_custkey, case when c_custkey % 7 = 0 then null else c_nationkey end as number from customer",
    "datetime_assemble": "select event_id, case when event_type = 'signup' then null when event_type = 'error' then cast(cast(ts as date) as {TSN}) else cast(cast(ts as date) as {TSN}) + interval '45296' second end as dt from events",
    "expect_not_null": "select 'c_custkey' as col, count(*) as n_rows, cast(sum(case when c_custkey is null then 1 else 0 end) as bigint) as n_bad from customer",
    "expect_length_between": "select count(*) as n_rows, cast(sum(case when length(p_name) not between 1 and 10 then 1 else 0 end) as bigint) as n_bad from part",
    "expect_value_between": "select count(*) as n_rows, cast(sum(case when c_acctbal not between 0 and 9000 then 1 else 0 end) as bigint) as n_bad from customer",
    "expect_distinct_equal_set": "select (select count(*) from orders where year(o_orderdate) not between 1996 and 2002) + (7 - (select count(distinct year(o_orderdate)) from orders where year(o_orderdate) between 1996 and 2002)) as n_mismatch",
    "expect_fk_in_set": "select count(*) as n_rows, cast(sum(case when o_custkey is null then 1 else 0 end) as bigint) as n_bad from customer left join (select distinct o_custkey from orders) o on c_custkey = o_custkey",
    "expect_unique": "select count(*) as n_dup_keys from (select l_orderkey, l_linenumber from lineitem group by l_orderkey, l_linenumber having count(*) > 1) t",
    "quality_report": "select 'not_null' as rule_name, cast(sum(case when c_custkey is null then 1 else 0 end) as bigint) as n_bad from customer union all select 'value_between' as rule_name, cast(sum(case when c_acctbal not between 0 and 9000 then 1 else 0 end) as bigint) as n_bad from customer",
    "surrogate_key": "select o_orderkey, race_key from {RACEKEY} t",
    "hash_key": "select c_custkey, md5(cast(c_custkey as {STR})) as hash_key from customer",
    "upsert_full": _UPSERT_CTE + " select t.c_custkey, t.c_name, t.c_acctbal from t left join n on t.c_custkey = n.c_custkey where n.c_custkey is null union all select c_custkey, c_name, c_acctbal from n",
    "upsert_key_only": _UPSERT_CTE + " select c_custkey, c_name, c_acctbal from t union all select n.c_custkey, null as c_name, null as c_acctbal from n left join t on t.c_custkey = n.c_custkey where t.c_custkey is null",
    "upsert_with_key": _UPSERT_CTE + " , tk as (select row_number() over (order by c_custkey) as k, c_custkey, c_name, c_acctbal from t), nk as (select (select count(*) from t) + row_number() over (order by n.c_custkey) as k, n.c_custkey, n.c_name, n.c_acctbal from n left join t on n.c_custkey = t.c_custkey where t.c_custkey is null) select tk.k as k, tk.c_custkey as c_custkey, case when n.c_custkey is null then tk.c_name else n.c_name end as c_name, case when n.c_custkey is null then tk.c_acctbal else n.c_acctbal end as c_acctbal from tk left join n on tk.c_custkey = n.c_custkey union all select k, c_custkey, c_name, c_acctbal from nk",
    "upsert_composite": f"select t.user_id, t.event_type, t.event_id, t.value from {_EV_OLD} t left join {_EV_NEW} n on t.user_id = n.user_id and t.event_type = n.event_type where n.user_id is null union all select user_id, event_type, event_id, value from {_EV_NEW} m",
    "silver_circuit": "select row_number() over (order by n_nationkey) as circuit_key, n_nationkey as circuit_id, n_name as circuit_name, case when n_nationkey % 7 = 0 then null else n_regionkey end as circuit_alt from nation",
    "silver_constructor": "select row_number() over (order by s_suppkey) as constructor_key, s_suppkey as constructor_id, s_name as constructor_ref, s_nationkey as nationality from supplier",
    "silver_driver": "select row_number() over (order by c_custkey) as driver_key, c_custkey as driver_id, c_name as driver_ref, case when c_custkey % 7 = 0 then null else c_nationkey end as number from customer",
    "silver_race": "select race_key, k.o_orderkey as race_id, cast(year(o_orderdate) as bigint) as race_year, case when k.o_orderkey % 7 = 0 then cast(cast(o_orderdate as date) as {TSN}) else cast(cast(o_orderdate as date) as {TSN}) + interval '45296' second end as race_datetime from {RACEKEY} k join orders o on k.o_orderkey = o.o_orderkey",
    "silver_race_result": "select row_number() over (order by result_id) as race_result_key, result_id, race_id, constructor_id, status_name, case when result_id % 7 = 0 then null else position_order end as position, points from {RESULT} a where l_linestatus = 'F'",
    "silver_sprint_result": "select row_number() over (order by result_id) as sprint_result_key, result_id, race_id, constructor_id, status_name, case when result_id % 7 = 0 then null else position_order end as position, points from {RESULT} a where l_linestatus = 'O'",
    "silver_status": "select status_key, status_name from {STATUSKEY} t",
    "star_dim_constructor": "select row_number() over (order by s_suppkey) as constructor_key, s_name as constructor_name, s_nationkey as constructor_nationality from supplier",
    "star_dim_driver": "select row_number() over (order by c_custkey) as driver_key, concat(c_mktsegment, ' ', c_name) as driver_fullname from customer",
    "star_dim_race": "select k.race_key, n.n_name as circuit_name, r.r_name as circuit_country, cast(year(o.o_orderdate) as bigint) as race_year, cast(o.o_orderdate as date) as race_date from orders o join {RACEKEY} k on o.o_orderkey = k.o_orderkey join customer c on o.o_custkey = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey",
    "star_dim_status": "select status_key, status_name from {STATUSKEY} t",
    "star_dim_circuit": "select row_number() over (order by n_nationkey) as circuit_key, n_nationkey as circuit_id, n_name as circuit_name, r_name as circuit_country, case when n_nationkey % 7 = 0 then null else n_regionkey end as circuit_alt from nation join region on n_regionkey = r_regionkey",
    "star_fct_race": "select f.result_id, k.race_key, d.driver_key, s.constructor_key, st.status_key, f.position_order, f.points from {RESULT} f join {RACEKEY} k on f.race_id = k.o_orderkey join {DRIVERKEY} d on k.o_custkey = d.c_custkey join {CONSKEY} s on f.constructor_id = s.s_suppkey join {STATUSKEY} st on f.status_name = st.status_name where f.l_linestatus = 'F'",
    "star_fct_sprint": "select f.result_id, k.race_key, d.driver_key, s.constructor_key, st.status_key, f.position_order, f.points from {RESULT} f join {RACEKEY} k on f.race_id = k.o_orderkey join {DRIVERKEY} d on k.o_custkey = d.c_custkey join {CONSKEY} s on f.constructor_id = s.s_suppkey join {STATUSKEY} st on f.status_name = st.status_name where f.l_linestatus = 'O'",
    "report_result": "select result_key, race_type, race_year, race_date, circuit_name, circuit_country, driver_fullname, constructor_name, status_name, position_order, points from {REPORT} p",
    "driver_standings": "select race_year, competitor, total_points, wins, season_rank from {DSTAND} u",
    "constructor_standings": "select race_year, competitor, total_points, wins, season_rank from {CSTAND} u",
    "champion_driver": "select race_year, competitor, total_points, wins from {DSTAND} u where season_rank = 1",
    "champion_constructor": "select race_year, competitor, total_points, wins from {CSTAND} u where season_rank = 1",
    "races_per_country": _COUNTRY_RACES,
    "top_countries": _COUNTRY_RACES + " order by races desc, circuit_country limit 3",
    "dangerous_circuits": "select circuit_name, count(*) as starts, cast(sum(case when status_name in ('RF', 'RO') then 1 else 0 end) as bigint) as incidents from {REPORT} p group by circuit_name",
    # second batches through published tables
    "silver_late_version": "select row_number() over (order by c_custkey) as driver_key, c_custkey as driver_id, case when c_custkey % 3 = 0 then concat(c_name, '_new') else c_name end as driver_ref from customer",
    "pipeline_two_batches": "select result_key, race_type, race_year, case when race_id % 7 = 1 then cast(date_trunc('year', race_date) as date) + 165 else race_date end as race_date, case when o_custkey % 5 = 0 then concat(driver_fullname, '_x') else driver_fullname end as driver_fullname, constructor_name, status_name, position_order, points + case position_order when 1 then 1000 when 2 then 500 else 0 end as points from {REPORT} p join (select o_orderkey, o_custkey from orders) o on o_orderkey = race_id",
    "fact_late_dimension": "select f.result_id, k.race_key, c.c_name as driver_ref, s.constructor_key, f.points from {RESULT} f join {RACEKEY} k on f.race_id = k.o_orderkey join customer c on k.o_custkey = c.c_custkey join {CONSKEY} s on f.constructor_id = s.s_suppkey where f.l_linestatus = 'F'",
    "incremental_ties": "select event_id, ts from events",
    "hash_key_multi": "select c_custkey, md5(concat(length(c_name), ':', c_name, case c_custkey % 3 when 0 then '~' when 1 then '0:' else concat(length(c_mktsegment), ':', c_mktsegment) end, coalesce(concat(length(cast(c_nationkey as varchar)), ':', c_nationkey), '~'))) as hash_key from customer",
    "cast_long_float": "select o_orderkey, case when o_orderkey % 7 = 0 then null else o_custkey end as milliseconds, case when o_orderkey % 7 = 0 then null else o_totalprice end as speed from orders",
    "expect_not_null_fk": "select 'c_custkey' as col, count(*) as n_rows, cast(0 as bigint) as n_bad from customer union all select 'nation_id' as col, count(*) as n_rows, cast(sum(case when c_custkey % 7 = 0 then 1 else 0 end) as bigint) as n_bad from customer",
    "gate_stops_load": "select c_custkey, c_name from customer",
    "incident_rate": "select *, incidents / starts as incident_rate from (select circuit_name, count(*) as starts, cast(sum(case when status_name in ('RF', 'RO') then 1 else 0 end) as bigint) as incidents from {REPORT} p group by circuit_name) q",
    "declared_schema": "select p_partkey, cast(p_size as bigint) as p_size, cast(p_retailprice as decimal(12, 2)) as p_retailprice from part",
    "clustered_load": "select 'l_partkey' as filter, count(*) as n_rows, cast(sum(l_orderkey) as bigint) as sum_keys, true as half_skipped from (select l_orderkey, l_partkey as v from lineitem) x, (select min(l_partkey) as lo, max(l_partkey) as hi from lineitem) m where v < lo + (hi - lo) // 20 union all select 'l_suppkey' as filter, count(*) as n_rows, cast(sum(l_orderkey) as bigint) as sum_keys, true as half_skipped from (select l_orderkey, l_suppkey as v from lineitem) x, (select min(l_suppkey) as lo, max(l_suppkey) as hi from lineitem) m where v < lo + (hi - lo) // 20 union all select 'l_shipdate' as filter, count(*) as n_rows, cast(sum(l_orderkey) as bigint) as sum_keys, true as half_skipped from (select l_orderkey, date_diff('day', date '1970-01-01', cast(l_shipdate as date)) as v from lineitem) x, (select min(date_diff('day', date '1970-01-01', cast(l_shipdate as date))) as lo, max(date_diff('day', date '1970-01-01', cast(l_shipdate as date))) as hi from lineitem) m where v < lo + (hi - lo) // 20",
    "bucketed_star": "select l_orderkey, any_value(o_custkey) as o_custkey, count(*) as n_lines, sum(l_quantity) as quantity from lineitem join orders on l_orderkey = o_orderkey group by l_orderkey",
    "sorted_load": "select count(*) as n_rows, cast(0 as bigint) as n_out_of_order from orders",
    "sql_year_totals": "select year(o_orderdate) as y, count(*) as n_orders, sum(case when o_orderstatus = 'F' then 1 else 0 end)::bigint as n_filled, max(o_totalprice) as top_price from orders group by year(o_orderdate)",
    # the racing configuration
    "racing_silver_race": "select row_number() over (order by o_orderkey) as race_key, o_orderkey as race_id, c_nationkey + 1 as circuit_id, year(o_orderdate) as year, o_orderkey % 20 as round, cast(cast(o_orderdate as date) as timestamp) + case when o_orderkey % 7 = 0 then interval 0 second else interval 45296 second end as datetime, case when (o_orderkey + 0) % 2 = 0 then cast(cast(o_orderdate as date) - 0 as timestamp) + case when o_orderkey % 7 = 0 then interval 0 second else interval 45296 second end end as fp1_datetime, case when (o_orderkey + 1) % 2 = 0 then cast(cast(o_orderdate as date) - 1 as timestamp) + case when o_orderkey % 7 = 0 then interval 0 second else interval 45296 second end end as fp2_datetime, case when (o_orderkey + 2) % 2 = 0 then cast(cast(o_orderdate as date) - 2 as timestamp) + case when o_orderkey % 7 = 0 then interval 0 second else interval 45296 second end end as fp3_datetime, case when (o_orderkey + 3) % 2 = 0 then cast(cast(o_orderdate as date) - 3 as timestamp) + case when o_orderkey % 7 = 0 then interval 0 second else interval 45296 second end end as quali_datetime, case when (o_orderkey + 4) % 2 = 0 then cast(cast(o_orderdate as date) - 4 as timestamp) + case when o_orderkey % 7 = 0 then interval 0 second else interval 45296 second end end as sprint_datetime from orders join customer on o_custkey = c_custkey",
    "racing_silver_result": "select row_number() over (order by rid) as race_result_key, rid as race_result_id, case when rid % 7 = 0 then null else l_linenumber end as car_number, case when rid % 7 = 0 then null else l_linenumber end as position, cast(l_quantity as integer) as laps, case when rid % 7 = 0 then null else l_partkey * 10000000000 end as milliseconds, case when rid % 7 = 0 then null else l_linenumber end as fastest_lap_rank, case when rid % 7 = 0 then null else l_extendedprice end as fastest_lap_speed from (select *, l_orderkey * 10 + l_linenumber as rid from {LATEST} x where l_linestatus = 'F') y",
    "racing_report": "select row_number() over (partition by l_linestatus order by rid) as result_key, case l_linestatus when 'F' then 'full_race' else 'sprint' end as race_type, o_orderpriority as race_name, year(o_orderdate) as race_year, cast(o_orderdate as date) as race_date, n_name as circuit_name, r_name as circuit_country, n_nationkey - 10.5 as circuit_lat, case when n_nationkey % 7 = 0 then null else n_regionkey end as circuit_alt, c_name as driver_ref, case when c_custkey % 7 = 0 then null else c_nationkey end as driver_number, concat(c_mktsegment, ' ', c_name) as driver_fullname, s_name as constructor_name, concat('status ', case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end) as status_name, l_linenumber as position_order, l_quantity as points, cast(l_quantity as integer) as laps, case when rid % 7 = 0 then null else l_partkey * 10000000000 end as milliseconds from (select *, l_orderkey * 10 + l_linenumber as rid from {LATEST} x) y join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join supplier on l_suppkey = s_suppkey",
    "racing_refresh": "select row_number() over (partition by l_linestatus order by rid) as result_key, case l_linestatus when 'F' then 'full_race' else 'sprint' end as race_type, o_orderpriority as race_name, n_name as circuit_name, concat(c_mktsegment, ' ', c_name) as driver_fullname, s_name as constructor_name, concat('status ', case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end) as status_name, l_quantity as points, true as few_blocks from (select *, l_orderkey * 10 + l_linenumber as rid from {LATEST} x) y join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join supplier on l_suppkey = s_suppkey",
    # The refreshed table must equal the latest event per (user, type)
    "stream_refresh": "select user_id, event_type, event_id, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn from events) q where rn = 1",
}


def expand(sql: str) -> str:
    """Substitute fragments until none is left."""
    for _ in range(10):
        changed = False
        for name, text in FRAGMENTS.items():
            token = "{" + name + "}"
            if token in sql:
                sql = sql.replace(token, text)
                changed = True
        if not changed:
            break
    return sql


def oracle_queries() -> dict[str, str]:
    return {k: expand(v) for k, v in RAW.items()}
