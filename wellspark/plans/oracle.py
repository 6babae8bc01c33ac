"""The same queries as SQL for an independent engine, for checking results only.

``TABLES`` names the shared building blocks; a query receives those it mentions, directly or
through others, as common table expressions.
"""

from __future__ import annotations

import re

TABLES: dict[str, str] = {
    "log": """
select event_id, ts, user_id, event_type, props, cast(ts as date) as event_date,
       cast(value as decimal(12,2)) as amount
from events""",
    "raw_device": """
select r_regionkey + 1 as device_id, r_name as brand, r_name || ' Band' as model,
       case when r_regionkey = 3 then 'scale' else 'wearable' end as category
from region""",
    "raw_user": """
select c_custkey as user_id, c_name as full_name,
       case when c_custkey % 2 = 0 then 'M' else 'F' end as sex,
       18 + c_custkey % 47 as age,
       cast((1500 + c_custkey % 400) / 10.0 as double) as height_cm, n_name as country,
       1 + c_custkey % 3 as primary_device_id,
       cast(date '1995-01-01' + cast(c_custkey % 365 as integer) as date) as signup_date
from customer left join nation on c_nationkey = n_nationkey""",
    "raw_history": """
select o_custkey as user_id,
       case when o_orderpriority = '1-URGENT' then 'pro'
            when o_orderpriority in ('2-HIGH', '3-MEDIUM') then 'plus' else 'free' end as membership_tier,
       o_orderstatus as company, cast(o_orderdate as date) as effective_from
from orders
qualify row_number() over (partition by o_custkey, cast(o_orderdate as date) order by o_orderkey desc) = 1""",
    "day_totals": """
select user_id, event_date as activity_date, count(*) as n,
       count(*) filter (where event_type <> 'error') as quiet, sum(amount) as total, max(amount) as top
from log group by user_id, event_date""",
    "raw_activity": """
select user_id, activity_date, 1 + user_id % 3 as device_id,
       greatest(least(cast(floor(total * 100) as bigint), 35000), 200) as steps,
       least(n * 15, 400) as active_minutes,
       cast(round(50 + least(cast(50 as decimal(12,2)), top), 1) as double) as resting_hr,
       least(660, quiet * 120) as sleep_minutes,
       least(660, quiet * 120) * 20 // 100 as sleep_deep_minutes,
       least(660, quiet * 120) * 22 // 100 as sleep_rem_minutes,
       least(660, quiet * 120) - least(660, quiet * 120) * 20 // 100
         - least(660, quiet * 120) * 22 // 100 as sleep_light_minutes,
       least(1200 + cast(floor(total * 10) as bigint), 20000) as calories
from day_totals""",
    "raw_intraday": """
select user_id, event_date as activity_date, cast(hour(ts) as bigint) as hour,
       greatest(least(50 + cast(floor(max(amount)) as bigint), 200), 35) as heart_rate
from log group by user_id, event_date, hour(ts)""",
    "raw_scan": """
select user_id, max(event_date) as scan_date, 4 as device_id,
       cast(round(40 + least(cast(160 as decimal(12,2)), max(amount)), 1) as double) as weight_kg,
       cast(round(16 + least(cast(24 as decimal(12,2)), min(amount)), 1) as double) as bmi,
       cast(round(5 + least(cast(50 as decimal(12,2)), min(amount)), 1) as double) as body_fat_pct,
       cast(round(20 + least(cast(60 as decimal(12,2)), max(amount)), 1) as double) as muscle_mass_kg,
       cast(round(1 + least(cast(29 as decimal(12,2)), min(amount)), 1) as double) as visceral_fat
from log group by user_id, date_trunc('week', event_date)""",
    "raw_meal": """
select user_id, cast(event_date + 1 as date) as log_date,
       case event_type when 'click' then 'Breakfast' when 'view' then 'LUNCH'
                       when 'purchase' then 'Dinner' else 'Snack' end as meal_type,
       amount + 100 as calories,
       round((amount + 100) * 0.07, 1) as protein_g,
       round((amount + 100) * 0.11, 1) as carbs_g,
       round((amount + 100) * 0.03, 1) as fat_g
from log""",
    "raw_experiment": """
select l.doc_id as user_id, 'quality_' || d.lang as experiment_name,
       case when l.doc_id % 2 = 0 then 'A' else 'B' end as variant, l.quality as engaged_next_day
from labels l join documents d on l.doc_id = d.doc_id""",
    "doc_lengths": """
select 'length_' || lang as experiment_name, case when doc_id % 2 = 0 then 'A' else 'B' end as variant,
       cast(n_chars as double) as n_chars
from documents""",
    "shipments": """
select o_custkey as user_id, cast(l_shipdate as date) as ship_date, l_orderkey, l_linenumber,
       cast(l_quantity as decimal(12,2)) as quantity, cast(l_extendedprice as decimal(12,2)) as price
from lineitem join orders on l_orderkey = o_orderkey""",
    "users": """
select user_id, full_name, sex, cast(age as integer) as age,
       cast(height_cm as decimal(5,1)) as height_cm, country,
       cast(primary_device_id as integer) as primary_device_id, signup_date
from raw_user""",
    "spans": """
select user_id, membership_tier, company, effective_from from raw_history""",
    "activity": """
select user_id, activity_date, cast(device_id as integer) as device_id,
       cast(steps as integer) as steps, cast(active_minutes as integer) as active_minutes,
       cast(resting_hr as decimal(5,1)) as resting_hr, cast(sleep_minutes as integer) as sleep_minutes,
       cast(sleep_deep_minutes as integer) as sleep_deep_minutes,
       cast(sleep_rem_minutes as integer) as sleep_rem_minutes,
       cast(sleep_light_minutes as integer) as sleep_light_minutes, cast(calories as integer) as calories
from raw_activity""",
    "scans": """
select user_id, scan_date, cast(device_id as integer) as device_id,
       cast(weight_kg as decimal(6,1)) as weight_kg, cast(bmi as decimal(4,1)) as bmi,
       cast(body_fat_pct as decimal(4,1)) as body_fat_pct,
       cast(muscle_mass_kg as decimal(5,1)) as muscle_mass_kg,
       cast(visceral_fat as decimal(4,1)) as visceral_fat
from raw_scan""",
    "meals": """
select user_id, log_date, lower(meal_type) as meal_type,
       cast(calories as decimal(7,1)) as calories, cast(protein_g as decimal(6,1)) as protein_g,
       cast(carbs_g as decimal(6,1)) as carbs_g, cast(fat_g as decimal(6,1)) as fat_g
from raw_meal""",
    "assignments": """
select user_id, experiment_name, variant,
       cast(engaged_next_day as integer) as engaged_next_day
from raw_experiment""",
    "newest_span": """
select * from spans qualify row_number() over (partition by user_id order by effective_from desc) = 1""",
    "current_users": """
select u.*, s.membership_tier, s.company, s.effective_from as tier_effective_from
from users u left join newest_span s on u.user_id = s.user_id""",
    "versions": """
select md5(cast(user_id as varchar) || '-' || cast(valid_from as varchar)) as user_version_key, *,
       valid_to = date '9999-12-31' as is_current
from (select user_id, membership_tier, company, effective_from as valid_from,
             coalesce(cast(lead(effective_from) over (partition by user_id order by effective_from) - 1 as date),
                      date '9999-12-31') as valid_to
      from spans)""",
    "enriched": """
select *, cast(case when sleep_minutes = 0 then null else
            round(cast((sleep_deep_minutes + sleep_rem_minutes) / sleep_minutes as decimal(18,9)), 3) end
          as double) as restorative_sleep_ratio,
       case when steps >= 10000 then true else false end as hit_step_goal
from activity""",
    "activity_fact": """
select user_id, cast(strftime(activity_date, '%Y%m%d') as integer) as date_key, activity_date, device_id,
       steps, active_minutes, resting_hr, calories, sleep_minutes, sleep_deep_minutes,
       sleep_rem_minutes, sleep_light_minutes, restorative_sleep_ratio, hit_step_goal
from enriched""",
    "scan_fact": """
select user_id, cast(strftime(scan_date, '%Y%m%d') as integer) as date_key, scan_date, device_id,
       weight_kg, bmi, body_fat_pct, muscle_mass_kg, visceral_fat
from scans""",
    "meal_days": """
select user_id, log_date, count(*) as meals_logged, sum(calories) as total_calories,
       sum(protein_g) as protein_g, sum(carbs_g) as carbs_g, sum(fat_g) as fat_g
from meals group by user_id, log_date""",
    "nutrition_fact": """
select m.user_id, cast(strftime(m.log_date, '%Y%m%d') as integer) as date_key, m.log_date, m.meals_logged,
       m.total_calories as calories_consumed, m.protein_g, m.carbs_g, m.fat_g,
       a.calories as calories_burned, m.total_calories - a.calories as calorie_balance
from meal_days m left join activity a on m.user_id = a.user_id and m.log_date = a.activity_date""",
    "scored": """
select user_id, activity_date,
       cast(round(cast(cast(score as varchar) as decimal(38,18)), 2) as double) as daily_score
from (select user_id, activity_date,
        (least(1.0::double, steps / 10000.0::double) * 0.4::double
         + greatest(0.0::double, 1.0::double - abs(sleep_minutes - 450) / 450.0::double) * 0.3::double
         + greatest(0.0::double, least(1.0::double,
             (90.0::double - cast(resting_hr as double)) / 35.0::double)) * 0.3::double) * 100.0::double as score
      from activity)""",
    "dates": """
select cast(strftime(date_day, '%Y%m%d') as integer) as date_key, date_day,
       isodow(date_day) >= 6 as is_weekend
from (select cast(unnest(generate_series(first, last, interval 1 day)) as date) as date_day
      from (select least((select min(event_date) from log), (select min(cast(o_orderdate as date)) from orders)) as first,
                   greatest((select max(event_date) from log), (select max(cast(o_orderdate as date)) from orders)) as last))""",
    "pipeline_dates": """
select cast(strftime(date_day, '%Y%m%d') as integer) as date_key, date_day
from (select cast(unnest(generate_series((select min(activity_date) from activity),
                                         (select max(log_date) from meals), interval 1 day)) as date) as date_day)""",
    "arms": """
select experiment_name, variant, cast(sum(engaged_next_day) as bigint) as engaged, count(*) as n,
       sum(engaged_next_day) / count(*) as rate
from assignments group by experiment_name, variant""",
    "paired": """
select a.experiment_name, a.engaged as engaged_a, b.engaged as engaged_b, a.n as n_a, b.n as n_b,
       a.rate as p_a, b.rate as p_b, b.rate - a.rate as effect
from arms a join arms b on a.experiment_name = b.experiment_name and a.variant = 'A' and b.variant = 'B'""",
    "paired_z": """
select *, case when se0 > 0 then effect / se0 else 0 end as z
from (select *, sqrt((engaged_a + engaged_b) / (n_a + n_b) * (1 - (engaged_a + engaged_b) / (n_a + n_b))
                     * (1 / n_a + 1 / n_b)) as se0,
             1.959963984540054 * sqrt(p_a * (1 - p_a) / n_a + p_b * (1 - p_b) / n_b) as margin
      from paired)""",
    "day_late": """
select user_id, event_date as activity_date, count(*) as n, sum(amount) as amount
from log group by user_id, event_date""",
    "day_early": """
select user_id, event_date as activity_date, count(*) as n, sum(amount) as amount
from log where event_type <> 'signup' group by user_id, event_date""",
    "readings": """
select event_id, user_id, epoch_us(ts) / 1000000 as ts,
       cast(greatest(least(40 + cast(floor(amount) as integer), 195), 40) as integer) as heart_rate,
       cast(json_extract_string(props, '$.k') as integer) as steps_delta, event_type as device,
       cast(('0x' || substr(md5('user:' || user_id), 1, 8))::bigint % 3 as integer) as "partition",
       event_id as "offset"
from log""",
}

SQL: dict[str, str] = {}


def _decimal_round(expression: str, digits: int, precision: str = "decimal(28,6)") -> str:
    return f"cast(round(cast({expression} as {precision}), {digits}) as double)"


def _normal_two_sided(z: str) -> str:
    """2 (1 - Phi(|z|)) by the power series of the normal integral."""
    series = (
        f"list_sum(list_transform(range(0, 150), lambda k: exp((2*k+1) * ln(abs({z}))"
        " - ((k+1) * ln(2) + lgamma(k + 1.5) - 0.5 * ln(pi())))))"
    )
    tail = f"1 - 2 * exp(-({z})*({z})/2) / sqrt(2*pi()) * {series}"
    return f"case when {z} = 0 then 1.0 else {tail} end"


def _normal_cdf(value: str) -> str:
    tail = f"({_normal_two_sided(value)}) / 2"
    return f"case when {value} > 0 then 1 - {tail} else {tail} end"


def _student_two_sided(t: str, df: str, panels: int = 4000) -> str:
    """1 - 2 * integral of the t density from 0 to |t|, by Simpson's rule."""
    density = (
        f"pow(1 + pow(abs({t}) * i / {panels}, 2) / {df}, -({df} + 1) / 2)"
        f" * (case when i in (0, {panels}) then 1 when i % 2 = 1 then 4 else 2 end)"
    )
    front = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi())"
    area = f"list_sum(list_transform(range(0, {panels} + 1), lambda i: {density})) * abs({t}) / {panels} / 3"
    return f"1 - 2 * {front} * {area}"


def _student_critical(df: str) -> str:
    """The 97.5% t quantile: its expansion around the normal quantile, then a Newton step."""
    z = 1.959963984540054
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    near = f"({z!r} + " + " + ".join(f"{c!r} / pow({df}, {i})" for i, c in enumerate(terms, 1)) + ")"
    density = (
        f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt({df} * pi())"
        f" * pow(1 + {near} * {near} / {df}, -({df} + 1) / 2)"
    )
    return f"({near} + ({_student_two_sided(near, df)} - 0.05) / (2 * {density}))"


def _power(n: str, alpha_z: str = "1.959963984540054") -> str:
    p2, bar = "(p_a + 0.03)", "((p_a + p_a + 0.03) / 2)"
    se1 = f"sqrt(p_a * (1 - p_a) / {n} + {p2} * (1 - {p2}) / {n})"
    value = f"(({alpha_z} * sqrt(2 * {bar} * (1 - {bar}) / {n}) - 0.03) / {se1})"
    return f"case when {p2} <= 1 then 1 - ({_normal_cdf(value)}) end"


def _needed(mde: str, alpha_z: str, power_z: str) -> str:
    p2, bar = f"(p_a + {mde})", f"((p_a + p_a + {mde}) / 2)"
    root = (
        f"{alpha_z} * sqrt(2 * {bar} * (1 - {bar})) + {power_z} * sqrt(p_a * (1 - p_a) + {p2} * (1 - {p2}))"
    )
    return f"case when {p2} <= 1 then cast(ceil(pow({root}, 2) / pow({mde}, 2)) as bigint) end"


Z_95, Z_99, Z_POWER_80, Z_POWER_90 = (
    "1.959963984540054",
    "2.5758293035489004",
    "0.8416212335729143",
    "1.2815515655446004",
)


def _doubles(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


# Sources, sinks, layout.

SQL["scan_parquet"] = """
select l_returnflag, l_linestatus, count(*) as n_lines,
       cast(sum(cast(l_quantity as decimal(12,2))) as double) as quantity
from lineitem group by l_returnflag, l_linestatus"""
SQL["scan_csv_typed"] = "select date_key, date_day, is_weekend from dates"
RAW_COUNTS = [
    ("dim_device", "raw_device"),
    ("dim_user", "raw_user"),
    ("user_attr_history", "raw_history"),
    ("daily_activity", "raw_activity"),
    ("intraday_hr", "raw_intraday"),
    ("body_scan", "raw_scan"),
    ("nutrition_log", "raw_meal"),
    ("experiment_assignment", "raw_experiment"),
]
SQL["source_registry"] = " union all ".join(
    f"select {i} as load_order, '{name}' as table_name, count(*) as n_rows from {cte}"
    for i, (name, cte) in enumerate(RAW_COUNTS)
)
SQL["load_audit"] = (
    "with counts as ("
    + " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows, "
        f"'{'append' if name == 'dim_user' else 'replace'}' as mode from {cte}"
        for name, cte in RAW_COUNTS
    )
    + ") select * from counts union all select 'TOTAL', cast(sum(n_rows) as bigint), '-' from counts"
)
SQL["load_audit_observed"] = SQL["load_audit"]
SQL["write_formats"] = """
select f.format, user_id, scan_date, weight_kg, bmi
from raw_scan cross join (select unnest(['parquet', 'csv']) as format) f"""
SQL["sample_extract"] = f"""
select user_id, activity_date, device_id, steps, active_minutes, {_doubles('resting_hr')}, sleep_minutes,
       sleep_deep_minutes, sleep_rem_minutes, sleep_light_minutes, calories
from activity where user_id between 1 and 5"""
SQL["load_warehouse_truncate"] = "select * from raw_intraday"
SQL["write_partitioned_year"] = """
select cast(year(ship_date) as integer) as year, count(*) as n_rows,
       cast(sum(quantity) as double) as quantity
from shipments group by year(ship_date)"""
SQL["layout_fact_tables"] = """
select 'activity' as table_name, activity_date as partition_date, count(*) as n_rows
from activity group by activity_date
union all
select 'scan', cast(date_trunc('month', scan_date) as date), count(*) from scans
group by cast(date_trunc('month', scan_date) as date)"""
SQL["preview"] = """
select *, (select count(*) from scored) as total_rows from scored
order by user_id, activity_date limit 15"""

# Staging.

SQL["stg_users"] = f"""
select user_id, full_name, sex, age, {_doubles('height_cm')}, country, primary_device_id, signup_date
from users"""
SQL["stg_devices"] = """
select cast(device_id as integer) as device_id, brand, model, category from raw_device"""
SQL["stg_user_attr_history"] = "select * from spans"
SQL["stg_daily_activity"] = SQL["sample_extract"].replace(" where user_id between 1 and 5", "")
SQL["stg_body_scan"] = f"""
select user_id, scan_date, device_id,
       {_doubles('weight_kg', 'bmi', 'body_fat_pct', 'muscle_mass_kg', 'visceral_fat')}
from scans"""
SQL["stg_nutrition_log"] = f"""
select user_id, log_date, meal_type, {_doubles('calories', 'protein_g', 'carbs_g', 'fat_g')} from meals"""
SQL["stg_experiment_assignment"] = "select * from assignments"

# Scalars.

SQL["date_key"] = """
select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_key from orders"""
SQL["restorative_sleep_ratio"] = "select user_id, activity_date, restorative_sleep_ratio from enriched"
SQL["hit_step_goal"] = "select user_id, activity_date, steps, hit_step_goal from enriched"
SQL["int_activity_enriched"] = f"""
select user_id, activity_date, device_id, steps, active_minutes, {_doubles('resting_hr')}, calories,
       sleep_minutes, sleep_deep_minutes, sleep_rem_minutes, sleep_light_minutes,
       restorative_sleep_ratio, hit_step_goal
from enriched"""
SQL["daily_subscore"] = "select * from scored"
SQL["calorie_balance"] = f"""
select user_id, log_date, {_doubles('calories_consumed')}, calories_burned, {_doubles('calorie_balance')}
from nutrition_fact"""
SQL["surrogate_key"] = """
select o_orderkey,
       md5(cast(o_custkey as varchar) || '-' || cast(cast(o_orderdate as date) as varchar)) as version_key
from orders"""
SQL["open_ended_sentinel"] = "select user_id, valid_from, valid_to, is_current from versions"
SQL["year_of_date"] = """
select l_orderkey, l_linenumber, cast(year(l_shipdate) as integer) as year from lineitem"""
SQL["weekend_flag"] = "select o_orderkey, isodow(o_orderdate) >= 6 as is_weekend from orders"
SQL["clip"] = "select event_id, cast(greatest(least(amount, 50), 5) as double) as clipped from log"
SQL["bmi_body_metrics"] = f"""
select s.user_id, s.scan_date, cast(s.weight_kg as double) as weight_kg,
       cast(u.height_cm as double) as height_cm,
       {_decimal_round('s.weight_kg * 10000 / (u.height_cm * u.height_cm)', 1, 'decimal(28,9)')} as bmi,
       cast(round(s.weight_kg * s.body_fat_pct * 0.01, 2) as double) as fat_mass_kg,
       cast(s.weight_kg - round(s.weight_kg * s.body_fat_pct * 0.01, 2) as double) as fat_free_mass_kg
from scans s left join users u on s.user_id = u.user_id"""
SQL["bmr_energy"] = """
with weighed as (
  select a.user_id, a.activity_date, a.steps, a.active_minutes, s.weight_kg
  from activity a left join scans s on a.user_id = s.user_id and s.scan_date <= a.activity_date
  qualify row_number() over (partition by a.user_id, a.activity_date order by s.scan_date desc nulls last) = 1),
burn as (
  select w.*, 10 * w.weight_kg + 6.25 * u.height_cm - 5 * u.age
              + (case when u.sex = 'M' then 5 else -161 end) as bmr
  from weighed w left join users u on w.user_id = u.user_id)
select user_id, activity_date, cast(weight_kg as double) as weight_kg,
       cast(round(bmr, 2) as double) as bmr_kcal,
       cast(round(bmr + steps * 0.04 + active_minutes * 4, 2) as double) as expected_kcal
from burn"""
SQL["body_fat_estimate"] = """
select s.user_id, s.scan_date, cast(s.bmi as double) as bmi,
       cast(greatest(least(round(1.20 * s.bmi + 0.23 * u.age
            - (case when u.sex = 'M' then 10.8 else 0.0 end) - 5.4, 1), 55), 5) as double) as body_fat_estimate
from scans s left join users u on s.user_id = u.user_id"""
SQL["macro_energy_share"] = """
with kcal as (select user_id, log_date, protein_g * 4 as protein_kcal, carbs_g * 4 as carbs_kcal,
                     fat_g * 9 as fat_kcal, protein_g * 4 + carbs_g * 4 + fat_g * 9 as macro_kcal
              from meal_days)
select user_id, log_date, """ + _doubles("protein_kcal", "carbs_kcal", "fat_kcal", "macro_kcal") + ", " + ", ".join(
    _decimal_round(f"{m}_kcal / macro_kcal", 4, "decimal(28,9)") + f" as {m}_share"
    for m in ("protein", "carbs", "fat")
) + " from kcal"

# Joins.

SQL["join_broadcast_left"] = """
select s.*, u.sex, u.age, u.country from scored s left join users u on s.user_id = u.user_id"""
SQL["join_left_two_key"] = "select user_id, log_date, meals_logged, calories_burned from nutrition_fact"
SQL["join_bucketed_facts"] = SQL["join_left_two_key"]
SQL["join_left_latest"] = "select user_id, membership_tier, company from current_users"
SQL["join_lookup_map"] = """
select a.user_id, a.activity_date, u.primary_device_id as device_id
from activity a left join users u on a.user_id = u.user_id"""
SQL["join_cross_scalar"] = """
select variant, count(*) as n, (select count(*) from assignments) as total_n
from assignments group by variant"""
SQL["join_semi"] = """
select * from raw_history
where user_id in (select c_custkey from customer where c_mktsegment = 'BUILDING')"""
SQL["join_anti_fk"] = """
select o_custkey as user_id, count(*) as n_rows from orders
where o_custkey not in (select user_id from events) group by o_custkey"""
SQL["join_asof_scd2"] = """
select f.user_id, f.ship_date, v.membership_tier, v.company, v.valid_from, v.valid_to,
       count(*) as n_lines, cast(sum(f.price) as double) as price
from shipments f left join versions v
  on f.user_id = v.user_id and f.ship_date between v.valid_from and v.valid_to
group by all"""
SQL["join_star_bi"] = """
select f.user_id, f.date_key, f.steps, d.date_day, d.is_weekend, u.country, u.membership_tier
from activity_fact f left join dates d on f.date_key = d.date_key
     left join current_users u on f.user_id = u.user_id"""

# Aggregations.

SQL["int_nutrition_daily"] = f"""
select user_id, log_date, meals_logged, {_doubles('total_calories', 'protein_g', 'carbs_g', 'fat_g')}
from meal_days"""
SQL["nutrition_daily_lines"] = """
select o_custkey as user_id, cast(l_shipdate as date) as log_date, count(*) as meals_logged,
       cast(sum(cast(l_extendedprice as decimal(12,2))) as double) as total_calories,
       cast(sum(cast(l_quantity as decimal(12,2))) as double) as protein_g,
       cast(sum(cast(l_discount as decimal(12,2))) as double) as carbs_g,
       cast(sum(cast(l_tax as decimal(12,2))) as double) as fat_g
from lineitem join orders on l_orderkey = o_orderkey group by o_custkey, cast(l_shipdate as date)"""
SQL["variant_summary"] = "select * from arms"
SQL["agg_filtered_count"] = """
select user_id, count(*) filter (where event_type = 'error') as errors,
       count(*) filter (where amount >= 50) as large
from log group by user_id"""
SQL["agg_having"] = """
select user_id, event_date, count(*) as n, cast(sum(amount) as double) as amount
from log group by user_id, event_date having count(*) >= 4 or sum(amount) > 200"""
SQL["agg_two_level_share"] = f"""
with counts as (select event_type, count(*) as n from log group by event_type),
total as (select cast(sum(n) as bigint) as total_n from counts)
select c.event_type, c.n, t.total_n, {_decimal_round('c.n / t.total_n', 6, 'decimal(28,9)')} as share
from counts c cross join total t"""
SQL["agg_high_water"] = """
select max(activity_date) as high_water, 'loaded' as target from activity_fact
union all select date '1900-01-01', 'empty'"""
SQL["agg_sufficient_stats"] = f"""
select experiment_name, variant, count(*) as n, {_decimal_round('avg(n_chars)', 2)} as mean,
       {_decimal_round('var_samp(n_chars)', 2)} as variance
from doc_lengths group by experiment_name, variant"""
SQL["agg_correlation"] = f"""
select count(*) as n, {_decimal_round('corr(steps, calories)', 6)} as correlation from activity"""
SQL["agg_rows_per_group"] = """
select count(*) as n_keys, min(n) as min_rows, max(n) as max_rows
from (select user_id, count(*) as n from events group by user_id)"""


def _mean(column: str) -> str:
    return _decimal_round(f"sum(cast({column} as decimal(20,1))) / count({column})", 2, "decimal(28,9)")


SQL["bi_activity_overview"] = f"""
select f.date_key, count(*) as user_days, {_mean('steps')} as avg_steps,
       {_mean('active_minutes')} as avg_active_minutes, {_mean('resting_hr')} as avg_resting_hr,
       any_value(d.date_day) as date_day, any_value(d.is_weekend) as is_weekend
from activity_fact f join current_users u on f.user_id = u.user_id
     left join dates d on f.date_key = d.date_key
where u.membership_tier = 'plus' group by f.date_key"""
SQL["bi_body_trend"] = f"""
select u.membership_tier, cast(date_trunc('month', f.scan_date) as date) as month, count(*) as scans,
       {_mean('weight_kg')} as avg_weight_kg, {_mean('body_fat_pct')} as avg_body_fat_pct,
       {_mean('muscle_mass_kg')} as avg_muscle_mass_kg
from scan_fact f left join current_users u on f.user_id = u.user_id
group by u.membership_tier, cast(date_trunc('month', f.scan_date) as date)"""
SQL["bi_balance_distribution"] = """
select cast(floor(cast(calorie_balance as double) / 100) * 100 as bigint) as balance_from, count(*) as n
from nutrition_fact group by 1"""


def _rolling(frame: str, name: str) -> str:
    total = "sum(cast(daily_score as decimal(20,2))) over w / count(daily_score) over w"
    return f"""
select user_id, activity_date, daily_score, {_decimal_round(total, 2, 'decimal(28,9)')} as {name},
       count(daily_score) over w as days_in_window
from scored window w as (partition by user_id order by activity_date {frame})"""


ROLLING_30 = _rolling("rows between 29 preceding and current row", "rolling_30d_score")
SQL["bi_score_series"] = f"""
select activity_date, count(rolling_30d_score) as users,
       {_decimal_round('sum(cast(rolling_30d_score as decimal(20,2))) / count(*)', 2, 'decimal(28,9)')} as avg_score
from ({ROLLING_30}) group by activity_date"""

# Windows.

SQL["rolling_30d_score"] = f"select user_id, activity_date, daily_score, rolling_30d_score from ({ROLLING_30})"
SQL["rolling_7d_score"] = _rolling("rows between 6 preceding and current row", "rolling_7d_score")
SQL["days_in_window"] = f"select user_id, activity_date, days_in_window from ({ROLLING_30})"
SQL["rolling_health_score"] = f"""
select r.user_id, r.activity_date, u.sex, u.age, u.country, r.daily_score, r.rolling_30d_score, r.days_in_window
from ({ROLLING_30}) r left join users u on r.user_id = u.user_id"""
SQL["rolling_30d_calendar"] = _rolling(
    "range between interval 29 days preceding and current row", "rolling_30d_score"
)
SQL["rolling_7d_calendar"] = _rolling(
    "range between interval 6 days preceding and current row", "rolling_7d_score"
)
SQL["latest_per_user"] = "select * from newest_span"
SQL["lead_valid_to"] = """
select user_id, effective_from,
       lead(effective_from) over (partition by user_id order by effective_from) as next_from
from spans"""
SQL["zscore_per_user"] = f"""
select user_id, activity_date,
       {_decimal_round('(steps - avg(steps) over w) / (stddev_pop(steps) over w + 1e-6)', 5)} as steps_z
from activity window w as (partition by user_id)"""
SQL["running_sum"] = """
select user_id, activity_date, steps,
       cast(sum(steps) over (partition by user_id order by activity_date) as bigint) as steps_so_far
from activity"""
SQL["cadence_downsample"] = """
select user_id, activity_date, steps
from (select *, min(activity_date) over (partition by user_id) as first from activity)
where datediff('day', first, activity_date) % 7 = 0"""
SQL["peak_relative"] = f"""
select user_id, activity_date, {_decimal_round('of_peak', 6)} as of_peak
from (select user_id, activity_date, case when peak = 0 then 0 else steps / peak end as of_peak
      from (select *, max(steps) over (partition by user_id) as peak from activity))"""

# Sort, limit, set operations, reshaping.

SQL["sort_history"] = "select * from spans order by user_id, effective_from"
SQL["top_n_preview"] = SQL["stg_daily_activity"] + " order by user_id, activity_date limit 15"
SQL["union_frames"] = """
select user_id, activity_date as day from activity
union all select user_id, scan_date from scans
union all select user_id, log_date from meals"""
SQL["table_diff"] = """
with later as (select user_id, case when event_type = 'signup' then 'view' else event_type end as event_type
               from events)
select 'before' as only_in, * from (select user_id, event_type from events except all select * from later)
union all
select 'after', * from (select * from later except all select user_id, event_type from events)"""
SQL["hourly_to_long"] = """
select k.user_id, k.activity_date, cast(h.hour as integer) as hour, r.heart_rate
from (select distinct user_id, activity_date from raw_intraday) k
     cross join (select unnest(range(24)) as hour) h
     left join raw_intraday r
       on r.user_id = k.user_id and r.activity_date = k.activity_date and r.hour = h.hour"""
SQL["hourly_summary"] = f"""
select user_id, activity_date, count(*) as hours, min(heart_rate) as min_hr,
       {_decimal_round('avg(heart_rate)', 2, 'decimal(28,9)')} as avg_hr, max(heart_rate) as max_hr,
       min(hour) filter (where heart_rate = peak) as peak_hour
from (select *, max(heart_rate) over (partition by user_id, activity_date) as peak from raw_intraday)
group by user_id, activity_date"""
SQL["date_spine"] = """
select cast(unnest(generate_series(last - 539, last, interval 1 day)) as date) as date_day
from (select max(cast(o_orderdate as date)) as last from orders)"""
SQL["dim_date"] = "select * from dates"

# Marts, incremental loads, history.

SQL["dim_device"] = SQL["stg_devices"]
SQL["dim_user"] = f"""
select user_id, full_name, sex, age, {_doubles('height_cm')}, country, primary_device_id, signup_date,
       membership_tier, company, tier_effective_from
from current_users"""
SQL["dim_user_scd2"] = "select * from versions"
SQL["fct_daily_activity"] = f"""
select * replace (cast(resting_hr as double) as resting_hr) from activity_fact"""
SQL["fct_body_scan"] = f"""
select user_id, date_key, scan_date, device_id,
       {_doubles('weight_kg', 'bmi', 'body_fat_pct', 'muscle_mass_kg', 'visceral_fat')}
from scan_fact"""
SQL["fct_nutrition"] = f"""
select user_id, date_key, log_date, meals_logged,
       {_doubles('calories_consumed', 'protein_g', 'carbs_g', 'fat_g')}, calories_burned,
       {_doubles('calorie_balance')}
from nutrition_fact"""


def _daily(late: str) -> str:
    """Late rows where the condition holds, early rows of the other days or keys."""
    columns = "user_id, activity_date, n, cast(amount as double) as amount"
    return f"""
select {columns} from day_late where {late}
union all
select {columns} from day_early where not ({late})"""


SQL["incremental_append"] = "select * replace (cast(amount as double) as amount) from day_late"
SQL["full_refresh"] = SQL["incremental_append"]
SQL["incremental_delete_insert"] = _daily("activity_date >= date '2024-01-10'")
SQL["incremental_null_dates"] = """
with late as (select user_id, case when user_id % 7 <> 3 then activity_date end as activity_date, n,
                     cast(amount as double) as amount from day_late),
early as (select user_id, activity_date, n, cast(amount as double) as amount
          from day_early where user_id % 7 <> 3)
select * from late where activity_date is null or activity_date >= date '2024-01-10'
union all
select * from early where activity_date < date '2024-01-10'"""
SQL["incremental_insert_overwrite"] = _daily("activity_date between date '2024-01-10' and date '2024-01-15'")
SQL["backfill_interval"] = SQL["incremental_insert_overwrite"]
SQL["incremental_late_upsert"] = """
with mark as (select max(activity_date) as m from day_early where activity_date <= date '2024-01-20'),
batch as (select d.* from day_late d, mark where d.activity_date > mark.m - 7),
kept as (select t.* from day_early t where t.activity_date <= date '2024-01-20' and not exists
         (select 1 from batch x where x.user_id = t.user_id and x.activity_date = t.activity_date))
select * replace (cast(amount as double) as amount) from (select * from kept union all select * from batch)"""
SQL["late_rows_to_scores"] = SQL["rolling_7d_score"]
SQL["scd2_snapshot"] = """
with runs as (select unnest([date '1997-01-01', date '1999-01-01', date '2001-12-31']) as run_at),
states as (select s.user_id, r.run_at, s.membership_tier, s.company
           from runs r join spans s on s.effective_from <= r.run_at
           qualify row_number() over (partition by s.user_id, r.run_at order by s.effective_from desc) = 1),
compared as (select *, lag(run_at) over w as before, lag(membership_tier) over w as old_tier,
                    lag(company) over w as old_company
             from states window w as (partition by user_id order by run_at)),
changes as (select * from compared
            where before is null or membership_tier is distinct from old_tier
               or company is distinct from old_company)
select user_id, membership_tier, company, run_at as valid_from,
       lead(run_at) over (partition by user_id order by run_at) as valid_to
from changes"""
SQL["rolling_backfill"] = f"""
select * from ({SQL['rolling_7d_calendar']})
where activity_date between date '2024-01-10' and date '2024-01-20'"""
SQL["rolling_backfill_rows"] = f"""
select * from ({SQL['rolling_7d_score']})
where activity_date between date '2024-01-10' and date '2024-01-20'"""

# Data quality. A counted check: (name, table, SQL giving the number of offending rows).

PIPELINE = {
    "stg_users": "users",
    "stg_devices": "raw_device",
    "stg_user_attr_history": "spans",
    "stg_daily_activity": "activity",
    "stg_body_scan": "scans",
    "stg_nutrition_log": "meals",
    "stg_experiment_assignment": "assignments",
    "dim_user": "current_users",
    "dim_device": "raw_device",
    "dim_user_scd2": "versions",
    "dim_date": "pipeline_dates",
    "fct_daily_activity": "activity_fact",
    "fct_body_scan": "scan_fact",
    "fct_nutrition": "nutrition_fact",
}


def _rows(prefix: str, where: str, names: dict[str, str]):
    def check(table: str, column: str, *args) -> tuple[str, str, str]:
        values = ", ".join(repr(a) for a in args)
        bounds = {"low": args[0], "high": args[-1]} if args else {}
        condition = where.format(c=column, values=values, **bounds)
        return f"{prefix}_{table}_{column}", table, f"select count(*) from {names[table]} where {condition}"

    return check


def _checks(names: dict[str, str]):
    not_null = _rows("not_null", "{c} is null", names)
    accepted = _rows("accepted_values", "{c} not in ({values})", names)
    between = _rows("accepted_range", "{c} < {low} or {c} > {high}", names)
    positive = _rows("positive", "{c} <= 0", names)

    def unique(table: str, *columns: str) -> tuple[str, str, str]:
        kind = "unique" if len(columns) == 1 else "unique_combination"
        cols, where = ", ".join(columns), f"where {columns[0]} is not null" if len(columns) == 1 else ""
        groups = f"select 1 from {names[table]} {where} group by {cols} having count(*) > 1"
        return f"{kind}_{table}_{'_'.join(columns)}", table, f"select count(*) from ({groups})"

    def related(table: str, column: str, parent: str, key: str) -> tuple[str, str, str]:
        return (
            f"relationships_{table}_{column}_{parent}",
            table,
            f"select count(*) from {names[table]} c where c.{column} is not null and not exists "
            f"(select 1 from {names[parent]} p where p.{key} = c.{column})",
        )

    return not_null, accepted, between, positive, unique, related


def _report(checks: list[tuple[str, str, str]]) -> str:
    lines = " union all ".join(
        f"select '{name}' as check_name, '{table}' as table_name, ({count}) as offenders"
        for name, table, count in checks
    )
    return f"select *, offenders = 0 as passed from ({lines})"


def _pipeline_report() -> str:
    not_null, accepted, between, positive, unique, related = _checks(PIPELINE)
    checks = []
    for table, key in (
        ("stg_users", "user_id"),
        ("stg_devices", "device_id"),
        ("stg_experiment_assignment", "user_id"),
        ("dim_user", "user_id"),
        ("dim_device", "device_id"),
        ("dim_user_scd2", "user_version_key"),
        ("dim_date", "date_key"),
        ("dim_date", "date_day"),
    ):
        checks += [unique(table, key), not_null(table, key)]
    for table, parent in (
        ("stg_user_attr_history", "stg_users"),
        ("stg_daily_activity", "stg_users"),
        ("stg_body_scan", "stg_users"),
        ("stg_nutrition_log", "stg_users"),
        ("dim_user_scd2", "dim_user"),
        ("fct_daily_activity", "dim_user"),
        ("fct_body_scan", "dim_user"),
        ("fct_nutrition", "dim_user"),
    ):
        checks += [not_null(table, "user_id"), related(table, "user_id", parent, "user_id")]
    tiers = ("free", "plus", "pro")
    checks += [
        accepted("stg_users", "sex", "M", "F"),
        not_null("stg_users", "primary_device_id"),
        related("stg_users", "primary_device_id", "stg_devices", "device_id"),
        accepted("stg_devices", "category", "wearable", "scale"),
        accepted("stg_user_attr_history", "membership_tier", *tiers),
        not_null("stg_user_attr_history", "effective_from"),
        not_null("stg_daily_activity", "activity_date"),
        between("stg_daily_activity", "steps", 0, 60000),
        between("stg_daily_activity", "resting_hr", 25, 120),
        unique("stg_daily_activity", "user_id", "activity_date"),
        between("stg_body_scan", "body_fat_pct", 3, 60),
        between("stg_body_scan", "weight_kg", 30, 250),
        accepted("stg_nutrition_log", "meal_type", "breakfast", "lunch", "dinner", "snack"),
        accepted("stg_experiment_assignment", "variant", "A", "B"),
        accepted("stg_experiment_assignment", "engaged_next_day", 0, 1),
        accepted("dim_user", "membership_tier", *tiers),
        related("dim_user", "primary_device_id", "dim_device", "device_id"),
        accepted("dim_user_scd2", "membership_tier", *tiers),
        not_null("dim_user_scd2", "is_current"),
        unique("dim_user_scd2", "user_id", "valid_from"),
        not_null("fct_daily_activity", "date_key"),
        *[
            related(table, "date_key", "dim_date", "date_key")
            for table in ("fct_daily_activity", "fct_body_scan", "fct_nutrition")
        ],
        between("fct_daily_activity", "restorative_sleep_ratio", 0, 1),
        not_null("fct_daily_activity", "hit_step_goal"),
        unique("fct_daily_activity", "user_id", "date_key"),
        positive("fct_daily_activity", "calories"),
        positive("fct_body_scan", "weight_kg"),
        between("fct_body_scan", "weight_kg", 30, 250),
        positive("fct_nutrition", "calories_consumed"),
        between("fct_nutrition", "meals_logged", 1, 10),
        (
            "experiment_balanced",
            "stg_experiment_assignment",
            "select count(*) from (select variant from assignments group by variant "
            "having count(*) / (select count(*) from assignments) < 0.35)",
        ),
        (
            "one_current_version",
            "dim_user_scd2",
            "select count(*) from (select user_id from versions group by user_id "
            "having count(*) filter (where is_current) <> 1)",
        ),
        (
            "sleep_stages_within_total",
            "stg_daily_activity",
            "select count(*) from activity where sleep_deep_minutes + sleep_rem_minutes "
            "+ sleep_light_minutes > sleep_minutes + 1",
        ),
    ]
    return f"select *, bool_and(passed) over () as published from ({_report(checks)})"


def _sample_report() -> str:
    names = {"activity": "activity", "users": "users", "meals": "meals", "lines": "lineitem"}
    not_null, accepted, between, positive, unique, related = _checks(names)
    return _report(
        [
            between("activity", "steps", 500, 30000),
            between("activity", "resting_hr", 25, 90),
            positive("activity", "sleep_minutes"),
            not_null("activity", "user_id"),
            accepted("meals", "meal_type", "breakfast", "lunch", "dinner"),
            accepted("users", "sex", "M", "F"),
            unique("meals", "user_id"),
            unique("users", "user_id"),
            unique("lines", "l_orderkey", "l_linenumber"),
            unique("activity", "user_id", "activity_date"),
            related("activity", "user_id", "users", "user_id"),
            related("users", "user_id", "activity", "user_id"),
            (
                "steps_without_sleep_activity_3000",
                "activity",
                "select count(*) from activity where steps >= 3000 and sleep_minutes = 0",
            ),
        ]
    )


SQL["run_pipeline"] = _pipeline_report()
SQL["dq_report"] = _sample_report()
SQL["expect_unique"] = """
select user_id, count(*) as n_rows from events where user_id is not null
group by user_id having count(*) > 1"""
SQL["expect_not_null"] = "select user_id, date_key from nutrition_fact where calories_burned is null"
SQL["expect_accepted_values"] = """
select event_id, event_type from events where event_type not in ('click', 'view', 'purchase')"""
SQL["expect_relationships"] = """
select c_custkey, count(*) as n_rows from customer
where c_custkey not in (select user_id from events) group by c_custkey"""
SQL["expect_accepted_range"] = """
select user_id, activity_date, steps from activity where steps <= 500 or steps >= 30000"""
SQL["expect_unique_combination"] = """
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
group by l_orderkey, l_linenumber having count(*) > 1"""
SQL["expect_positive"] = """
select user_id, activity_date, sleep_minutes from activity where sleep_minutes <= 0"""
SQL["expect_custom"] = """
select user_id, activity_date, steps from activity where steps >= 3000 and sleep_minutes = 0"""
SQL["check_experiment_balanced"] = f"""
with counts as (select event_type as variant, count(*) as n from log group by event_type),
total as (select cast(sum(n) as bigint) as total_n from counts)
select c.variant, c.n, t.total_n, {_decimal_round('c.n / t.total_n', 6, 'decimal(28,9)')} as share
from counts c cross join total t where c.n / t.total_n < 0.2"""
SQL["check_one_current"] = """
select user_id, count(*) filter (where is_current and valid_from < date '2000-08-01') as current_versions
from versions group by user_id
having count(*) filter (where is_current and valid_from < date '2000-08-01') <> 1"""
SQL["check_sleep_stages"] = """
select user_id, activity_date, sleep_minutes,
       sleep_deep_minutes + 2 * sleep_rem_minutes + sleep_light_minutes as stage_sum
from activity where sleep_deep_minutes + 2 * sleep_rem_minutes + sleep_light_minutes > sleep_minutes + 1"""
SQL["check_span_overlap"] = """
select user_id, valid_from, valid_to, next_from
from (select user_id, valid_from,
             case when is_current then valid_to else cast(valid_to + 30 as date) end as valid_to,
             lead(valid_from) over (partition by user_id order by valid_from) as next_from
      from versions)
where next_from <= valid_to"""
SQL["check_grain_complete"] = """
select u.user_id, d.activity_date
from (select distinct user_id from activity) u
     cross join (select cast(unnest(generate_series(min(activity_date), max(activity_date), interval 1 day)) as date)
                        as activity_date from activity) d
except select user_id, activity_date from activity"""
SQL["check_grain_hours"] = """
select u.user_id, d.activity_date, h.hour
from (select distinct user_id from raw_intraday) u
     cross join (select cast(unnest(generate_series(min(activity_date), max(activity_date), interval 1 day)) as date)
                        as activity_date from raw_intraday) d
     cross join (select cast(unnest(range(24)) as bigint) as hour) h
except select user_id, activity_date, hour from raw_intraday"""
SQL["check_schema"] = """
select n.n_rows, t.table_name, t.column_name
from (values ('wearable_events', 'heart_rate'), ('wearable_events', 'steps_delta'),
             ('wearable_events', 'device'), ('daily_activity', 'activity_date'),
             ('daily_activity', 'device_id'), ('daily_activity', 'steps'),
             ('daily_activity', 'active_minutes'), ('daily_activity', 'resting_hr'),
             ('daily_activity', 'sleep_minutes'), ('daily_activity', 'sleep_deep_minutes'),
             ('daily_activity', 'sleep_rem_minutes'), ('daily_activity', 'sleep_light_minutes'),
             ('daily_activity', 'calories')) t(table_name, column_name)
     cross join (select count(*) as n_rows from events) n"""
SQL["check_reconcile_load"] = """
select s.n as source_rows, e.n as loaded_rows, 'incomplete' as load
from (select count(*) as n from day_late) s cross join (select count(*) as n from day_early) e
where s.n <> e.n"""
SQL["check_reconcile_observed"] = SQL["check_reconcile_load"]

# Experiment statistics.

SQL["ab_ztest"] = f"""
select experiment_name, engaged_a, engaged_b, n_a, n_b, {_decimal_round('p_a', 6)} as p_a,
       {_decimal_round('p_b', 6)} as p_b, {_decimal_round('effect', 6)} as effect,
       {_decimal_round('z', 6)} as z, {_decimal_round(_normal_two_sided('z'), 6)} as p_value,
       {_decimal_round('effect - margin', 6)} as ci_low, {_decimal_round('effect + margin', 6)} as ci_high
from paired_z"""


def _welch(source: str) -> str:
    """Both arms of each experiment in (experiment_name, variant, value) rows."""
    return f"""
select *, effect / sqrt(sum_q) as t,
       pow(sum_q, 2) / (pow(variance_a / n_a, 2) / (n_a - 1) + pow(variance_b / n_b, 2) / (n_b - 1)) as df
from (select a.experiment_name, a.n as n_a, b.n as n_b, a.mean as mean_a, b.mean as mean_b,
             a.variance as variance_a, b.variance as variance_b, b.mean - a.mean as effect,
             a.variance / a.n + b.variance / b.n as sum_q
      from ({source}) a join ({source}) b
        on a.experiment_name = b.experiment_name and a.variant = 'A' and b.variant = 'B')"""


def _arm(table: str, value: str) -> str:
    return (
        f"select experiment_name, variant, count(*) as n, avg({value}) as mean, "
        f"var_samp({value}) as variance from {table} group by experiment_name, variant"
    )


SQL["ab_welch"] = f"""
select experiment_name, n_a, n_b, {_decimal_round('mean_a', 2)} as mean_a, {_decimal_round('mean_b', 2)} as mean_b,
       {_decimal_round('variance_a', 2)} as variance_a, {_decimal_round('variance_b', 2)} as variance_b,
       {_decimal_round('effect', 2)} as effect, {_decimal_round('t', 5)} as t, {_decimal_round('df', 5)} as df,
       {_decimal_round(_student_two_sided('t', 'df'), 5)} as p_value,
       {_decimal_round(f"effect - {_student_critical('df')} * sqrt(sum_q)", 2)} as ci_low,
       {_decimal_round(f"effect + {_student_critical('df')} * sqrt(sum_q)", 2)} as ci_high
from ({_welch(_arm('doc_lengths', 'n_chars'))})"""
SQL["ab_sample_size"] = f"""
select experiment_name, {_needed('0.03', Z_95, Z_POWER_80)} as n_default,
       {_needed('0.05', Z_95, Z_POWER_80)} as n_mde_5, {_needed('0.05', Z_99, Z_POWER_90)} as n_strict
from paired"""
SQL["ab_power"] = f"""
select experiment_name, n_a, {_decimal_round(_power('n_a'), 6)} as achieved_power from paired"""
SQL["ab_power_curve"] = f"""
select experiment_name, n, {_decimal_round(_power('n'), 6)} as power
from paired cross join (select cast(unnest(range(100, 6000, 100)) as integer) as n)"""
SQL["ab_wald_error"] = f"""
select experiment_name, variant, engaged, n, {_decimal_round('rate', 6)} as rate,
       {_decimal_round('1.96 * sqrt(rate * (1 - rate) / n)', 6)} as error
from arms"""
SQL["ab_decision_report"] = f"""
with t as ({_welch(_arm('assignments', 'engaged_next_day'))}),
r as (select z.*, t.t, t.df, t.sum_q as t_both, {_normal_two_sided('z')} as z_p
      from paired_z z join t on z.experiment_name = t.experiment_name)
select experiment_name, engaged_a, engaged_b, n_a, n_b, {_decimal_round('p_a', 5)} as p_a,
       {_decimal_round('p_b', 5)} as p_b, {_decimal_round('effect', 5)} as effect, {_decimal_round('z', 5)} as z,
       {_decimal_round('z_p', 5)} as z_p_value, {_decimal_round('effect - margin', 5)} as z_ci_low,
       {_decimal_round('effect + margin', 5)} as z_ci_high, {_decimal_round('t', 5)} as t,
       {_decimal_round('df', 5)} as df, {_decimal_round(_student_two_sided('t', 'df'), 5)} as t_p_value,
       {_decimal_round(f"effect - {_student_critical('df')} * sqrt(t_both)", 5)} as t_ci_low,
       {_decimal_round(f"effect + {_student_critical('df')} * sqrt(t_both)", 5)} as t_ci_high,
       {_needed('0.03', Z_95, Z_POWER_80)} as required_n,
       {_decimal_round(_power('n_a'), 5)} as achieved_power,
       case when z_p < 0.05 then 'reject' else 'fail to reject' end as decision
from r"""
SQL["ab_assign"] = """
select user_id, 'template_test' as experiment_name,
       case when ('0x' || substr(md5('template_test:' || user_id), 1, 8))::bigint % 10000 < 5000
            then 'B' else 'A' end as variant
from users"""
DRAWN = """
select user_id, sex, ('0x' || substr(md5('primary_device:' || user_id), 1, 8))::bigint % 1000000 as draw
from users"""
OPTIONS = """
select device_id, count(*) as weight from raw_device, customer, nation
where category = 'wearable' and c_nationkey = n_nationkey and n_regionkey + 1 = device_id
group by device_id"""
PARTS = """
select device_id, (coalesce(sum(weight) over (order by device_id rows between unbounded preceding and 1 preceding), 0)
                   * 1000000 // sum(weight) over ())::bigint as low,
       (sum(weight) over (order by device_id rows unbounded preceding) * 1000000 // sum(weight) over ())::bigint as high"""
SQL["weighted_assign"] = f"""
select user_id, device_id
from ({DRAWN}) d left join ({PARTS} from ({OPTIONS})) o on d.draw >= o.low and d.draw < o.high"""
SQL["weighted_assign_within"] = f"""
select user_id, device_id
from ({DRAWN}) d left join ({PARTS} from ({OPTIONS}) where device_id <> 1) o
     on d.draw >= o.low and d.draw < o.high and d.sex = 'F'"""

# Streaming.

SQL["stream_source"] = "select event_id, user_id, event_type from events"
READING = 'event_id, user_id, ts, heart_rate, steps_delta, device, "partition", "offset"'
SQL["stream_decode"] = f"select {READING} from readings"
SQL["stream_event_time"] = "select event_id, epoch_us(ts) as event_micros from events"
SQL["stream_upsert_ignore"] = SQL["stream_decode"]
SQL["stream_at_least_once"] = """
select "partition", count(*) as events, cast(sum(heart_rate) as bigint) as heart_rate
from readings group by "partition\""""
SQL["stream_random_ids"] = """
select user_id, count(*) as events, cast(sum(heart_rate) as bigint) as heart_rate from readings group by user_id"""
SQL["stream_bounded_run"] = """
select user_id, count(*) as events, 'bounded' as run from readings where user_id % 2 = 0 group by user_id
union all
select user_id, count(*), 'rest' from readings group by user_id"""
SQL["stream_publish"] = """
select cast(user_id as varchar) as key, event_id, cast(user_id as bigint) as user_id,
       cast(heart_rate as bigint) as heart_rate, cast(steps_delta as bigint) as steps_delta, device
from readings"""
SQL["stream_partition_key"] = """
select user_id, cast(('0x' || substr(md5('user:' || user_id), 1, 8))::bigint % 3 as integer) as "partition"
from users"""
SQL["stream_order_audit"] = """
select user_id, min(p) as first, max(p) as last, 'event type' as placed_by
from (select user_id, cast(('0x' || substr(md5('user:' || device), 1, 8))::bigint % 3 as integer) as p
      from readings)
group by user_id having min(p) <> max(p)
union all
select user_id, min("partition"), max("partition"), 'key' from readings
group by user_id having min("partition") <> max("partition")""".replace("'event type'", "'device'")
SQL["stream_partition_spread"] = """
select "partition", count(*) as events, count(distinct user_id) as users from readings group by "partition\""""


def _gaps(source: str) -> str:
    return f"""
select p as "partition", after_offset, at_offset, coalesce(at_offset - after_offset - 1, 0) as missing, repeats
from (select p, o as at_offset, lag(o) over (partition by p order by o) as after_offset, n - 1 as repeats
      from (select p, o, count(*) as n from ({source}) group by p, o))
where coalesce(at_offset - after_offset - 1, 0) > 0 or repeats > 0"""


SQL["stream_offset_gaps"] = _gaps('select "partition" as p, "offset" as o from readings')
SQL["offset_gaps_lines"] = _gaps("select l_orderkey as p, cast(l_linenumber as bigint) as o from lineitem")
SQL["stream_error_rows"] = """
select event_id as "offset", case event_id % 10 when 3 then 'not decodable' when 5 then 'no value'
       when 7 then 'missing field' else 'stored' end as outcome
from events"""


def _with_tables(body: str) -> str:
    """Prefix the building blocks the query needs, in an order that defines each before use."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(TABLES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    blocks = ",\n".join(f"{name} as ({TABLES[name].strip()})" for name in needed)
    body = body.strip()
    if body.startswith("with "):
        return f"with {blocks},\n{body[5:]}"
    return f"with {blocks}\n{body}"


ORACLE: dict[str, str] = {name: _with_tables(body) for name, body in SQL.items()}
