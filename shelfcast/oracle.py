"""SQL twins of the catalog's queries, written independently of the Spark code.

Fragments are common table expressions over the star-schema views; each query is the list of
fragments it needs and a final SELECT.
"""

from __future__ import annotations

WARDS = [f"N{i}" for i in range(25)]
LINE_LABS = ["AF", "AO", "NF", "NO", "RF", "RO"]
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
EXACT = "bigint"


def trailing(agg: str, col: str, k: int, part: str = "") -> str:
    over = f"over ({part} order by date rows {k - 1} preceding)"
    return f"case when count({col}) {over} = {k} then {agg}({col}) {over} end"


def pos(v: str) -> str:
    return f"(case when {v} > 0 then {v} when {v} <= 0 then 0 end)"


def r6(expr: str, name: str) -> str:
    return f'round({expr}, 6) as "{name}"'


USAGE = """usage as (
  select cast(l_shipdate as date) as date, count(*) as used
  from lineitem where l_returnflag = 'R' group by 1)"""

SITE_USAGE = """site_usage as (
  select c_nationkey as site, cast(l_shipdate as date) as date, count(*) as used
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  where l_returnflag = 'R' group by 1, 2)"""

EVENT_VALUES = r"""texts as (
  select cast(ts as date) as date, event_type as base_name,
    case when event_id % 50 = 0 then '<0.1' when event_id % 97 = 0 then 'ERR'
         else cast(value as varchar) end as ord_value
  from events),
event_values as (
  select date, base_name, ord_value,
    try_cast(regexp_replace(ord_value, '^<0.1', '0') as double) as lab_value
  from texts)"""

LINE_VALUES = """line_values as (
  select cast(l_shipdate as date) as date, l_returnflag || l_linestatus as base_name,
    l_quantity as lab_value
  from lineitem)"""

CENSUS = """census as (
  select cast(o_orderdate as date) as date, 'N' || cast(c_nationkey as varchar) as ward,
    count(*) as n
  from orders join customer on o_custkey = c_custkey group by 1, 2)"""

CENSUS_WIDE = "census_wide as (select date, " + ", ".join(
    f"cast(coalesce(sum(n) filter (where ward = '{w}'), 0) as bigint) as {w}" for w in WARDS
) + " from census group by date)"


def threshold_counts(source: str, name: str, const: dict[str, float], above: str) -> str:
    """Threshold = day quartile unless constant; one lab is counted at or above it."""
    cases = " ".join(f"when base_name = '{k}' then {v}" for k, v in const.items())
    return f"""{name}_q as (
  select date, base_name,
    case {cases} else quantile_cont(lab_value, 0.25) end as threshold
  from {source} group by date, base_name),
{name} as (
  select s.date, s.base_name, count(*) as n,
    count(*) filter (where lab_value < threshold) as below,
    count(*) filter (where lab_value >= threshold) as above,
    case when s.base_name = '{above}' then count(*) filter (where lab_value >= threshold)
         else count(*) filter (where lab_value < threshold) end as nq
  from {source} s join {name}_q q on s.date = q.date and s.base_name = q.base_name
  group by s.date, s.base_name)"""


LINE_COUNTS = threshold_counts("line_values", "line_counts", {"AO": 12.0, "RF": 25.0}, "NO")

FEATURES = "features as (select date, " + ", ".join(
    f"cast(coalesce(sum(nq) filter (where base_name = '{b}'), 0) as bigint) as {b}_Nq"
    for b in LINE_LABS
) + " from line_counts group by date)"

SMOOTHED = "smoothed as (select date, " + ", ".join(
    f"{trailing('avg', f'{b}_Nq', 7)} as {b}_Nq" for b in LINE_LABS
) + " from features)"

PREDICTORS = [*WEEKDAYS, "seven_lag", *[f"{b}_Nq" for b in LINE_LABS], *WARDS]

TRAINING = f"""lagged as (
  select date, used as plt_used, {trailing('avg', 'used', 7)} as seven_lag from usage),
training as (
  select l.date, {', '.join(f'cast(isodow(l.date) = {k} as integer) as {d}' for k, d in enumerate(WEEKDAYS, 1))},
    seven_lag, {', '.join(f'{b}_Nq' for b in LINE_LABS)}, {', '.join(WARDS)}, plt_used
  from lagged l join smoothed s on l.date = s.date join census_wide c on l.date = c.date)"""

TRAINING_PARTS = [USAGE, LINE_VALUES, LINE_COUNTS, FEATURES, SMOOTHED, CENSUS, CENSUS_WIDE, TRAINING]

H = 50
SMOOTHED_PREDICTORS = ["seven_lag", *[f"{b}_Nq" for b in LINE_LABS]]


def _frame(c: str) -> str:
    return "short_frame" if c in SMOOTHED_PREDICTORS else "long_frame"


ROLLING = (
    "rolling_wide as (\n  select date, row_number() over (order by date) as rn, "
    + ", ".join(
        f"avg({c}) over {_frame(c)} as c_{c}, stddev_samp({c}) over {_frame(c)} as s_{c}"
        for c in PREDICTORS
    )
    + f""" from training
  window short_frame as (order by date rows between {H - 6} preceding and 1 preceding),
         long_frame as (order by date rows between {H} preceding and 1 preceding)),
rolling as ("""
    + " union all ".join(
        f"select date, '{c}' as predictor, case when rn > {H} then c_{c} end as center, "
        f"case when rn > {H} then s_{c} end as scale from rolling_wide"
        for c in PREDICTORS
    )
    + ")"
)


def runs(dates: str) -> str:
    return f"""gaps as (
  select date, coalesce(date_diff('day', lag(date) over (order by date), date), 1) as gap,
    case when date >= date '1998-07-01' then 100 else 200 end as window_length
  from {dates}),
aged as (
  select date, gap, day(date) = 15 as multi,
    sum(gap) over (order by date rows between unbounded preceding and 1 preceding) as age_before,
    window_length is distinct from lag(window_length) over (order by date) as changed
  from gaps),
ages as (
  select date, cast(age_before as integer) as age_before,
    case when age_before is null then 'first' when multi then 'several dates'
         when changed then 'parameters changed'
         when age_before % 7 = 0 or gap > 7 then 'stale' end as reason
  from aged)"""


def batch(odd: int) -> str:
    return f"""batch{odd} as (
  select cast(l_shipdate as date) as date, count(*) as used
  from lineitem
  where l_returnflag = 'R' and coalesce(abs(l_orderkey % 2), 0) = {odd} group by 1)"""


ACCUMULATED = """accumulated as (
  select date, cast(sum(used) as bigint) as used
  from (select * from batch0 union all select * from batch1) group by date)"""

DAYS = f"""days as (
  select cast(0 as integer) as site, s.date, u.used as plt_used, 3 * p.lag7 as t_pred
  from (select cast(unnest(generate_series(min(date), max(date) + 2, interval 1 day)) as date) as date
        from usage) s
  left join usage u on s.date = u.date
  left join (select date, {trailing('avg', 'used', 7)} as lag7 from usage) p on s.date = p.date)"""

SITE_DAYS = f"""spine as (
  select cast(unnest(generate_series(min(date), max(date) + 2, interval 1 day)) as date) as date,
    max(date) as hi
  from site_usage),
filled as (
  select k.site, s.date,
    case when s.date <= s.hi then coalesce(u.used, 0) end as plt_used
  from (select distinct site from site_usage) k cross join spine s
  left join site_usage u on u.site = k.site and u.date = s.date),
days as (
  select site, date, plt_used, 3 * {trailing('avg', 'plt_used', 7, 'partition by site')} as t_pred
  from filled)"""

START, MIN_INVENTORY = 10, 30


def ledger() -> str:
    """The ordering recurrence as a recursive query; x1..x3 arrive in one to three days."""
    need = "floor(" + pos("t - p.x2 - p.x3 - n_r1 - n_r2 + 1") + ")"
    need_adj = "floor(" + pos(f"t + {pos(f'{MIN_INVENTORY} - n_r1 - n_r2')} - p.a2 - p.a3 - n_ra1 - n_ra2 + 1") + ")"
    y = "y"
    return f"""numbered as (
  select site, date, cast(plt_used as double) as y, cast(t_pred as double) as t,
    row_number() over (partition by site order by date) as i
  from days),
steps as (
  select site, date, i, y, t, r1, r2, w, x, s, t as t_adj, ra1, ra2, wa, a as xa, sa,
    60.0::double as x1, 60.0::double as x2,
    floor({pos('t - 120 - r1 - r2 + 1')})::double as x3,
    60.0::double as a1, 60.0::double as a2,
    floor({pos('t - 120 - r1 - r2 + 1')})::double as a3
  from (select *, {pos('0 - y')}::double as w, {pos('0 - y')}::double as r1,
          60.0::double as x, 60.0::double as a, {pos('y - 60')}::double as s,
          {pos(f"60 - {pos('y')}")}::double as r2,
          0.0::double as ra1, 0.0::double as ra2, 0.0::double as wa, 0.0::double as sa
        from numbered where i = {START})
  union all
  select site, date, i, y, t, n_r1, n_r2, n_w, p_x1, n_s,
    t + {pos(f'{MIN_INVENTORY} - n_r1 - n_r2')}, n_ra1, n_ra2, n_wa, p_a1, n_sa,
    p_x2, p_x3, {need.replace('p.x2', 'p_x2').replace('p.x3', 'p_x3')},
    p_a2, p_a3, {need_adj.replace('p.a2', 'p_a2').replace('p.a3', 'p_a3')}
  from (
    select *, {pos('p_r1 + p_r2 - y - n_w')} as n_r1, {pos('p_ra1 + p_ra2 - y - n_wa')} as n_ra1
    from (
      select d.site, d.date, d.i, d.y, d.t, p.r1 as p_r1, p.r2 as p_r2, p.ra1 as p_ra1,
        p.ra2 as p_ra2, p.x1 as p_x1, p.x2 as p_x2, p.x3 as p_x3, p.a1 as p_a1, p.a2 as p_a2,
        p.a3 as p_a3,
        {pos('p.r1 - d.y')} as n_w, {pos('d.y - p.r1 - p.r2 - p.x1')} as n_s,
        {pos('p.x1 - ' + pos('d.y - p.r1 - p.r2'))} as n_r2,
        {pos('p.ra1 - d.y')} as n_wa, {pos('d.y - p.ra1 - p.ra2 - p.a1')} as n_sa,
        {pos('p.a1 - ' + pos('d.y - p.ra1 - p.ra2'))} as n_ra2
      from steps p join numbered d on d.site = p.site and d.i = p.i + 1))),
ledger as (
  select site, date, y as plt_used, t as t_pred, r1 + r2 <= {MIN_INVENTORY} as alert,
    r1, r2, w, x, s, t_adj, ra1 as r1_adj, ra2 as r2_adj, wa as w_adj, xa as x_adj, sa as s_adj, i
  from steps
  union all
  select site, date, y, t, true, 0, 0, 0, 0, 0, t, 0, 0, 0, 0, 0, i from numbered
  where i < {START})"""


LEDGER = ledger()
LEDGER_COLUMNS = ["plt_used", "t_pred", "r1", "r2", "w", "x", "s", "t_adj", "r1_adj", "r2_adj",
                  "w_adj", "x_adj", "s_adj"]
SITE_LEDGER = [SITE_USAGE, SITE_DAYS, LEDGER]

INVENTORY = """stock as (
  select cast(l_shipdate as date) as date, l_returnflag as type,
    (l_quantity % 5) - 1 + case when l_partkey % 2 = 1 then 0.5::double else 0.0::double end
      as days_to_expire
  from lineitem)"""

BUCKETS = """buckets as (
  select date, count(*) as count,
    count(*) filter (where days_to_expire <= 1) as r1,
    count(*) filter (where days_to_expire > 1 and days_to_expire <= 2) as r2,
    count(*) filter (where days_to_expire > 2) as r3_plus
  from stock where type = 'R' and days_to_expire > 0 group by date)"""

REPORT_NAMES = [
    ("plt_used", "Platelet usage"), ("t_pred", "Three-day prediction"),
    ("r1", "No. expiring in 1 day"), ("r2", "No. expiring in 2 days"), ("w", "Waste"),
    ("x", "No. to order per prediction"), ("s", "Shortage"),
    ("t_adj", "Adj. three-day prediction"), ("r1_adj", "Adj. no. expiring in 1 day"),
    ("r2_adj", "Adj. no. expiring in 2 days"), ("w_adj", "Adj. waste"),
    ("x_adj", "Adj. no. to order"), ("s_adj", "Adj. shortage"),
]


def _query(parts: list[str], select: str) -> str:
    recursive = "recursive " if LEDGER in parts else ""
    return f"with {recursive}" + ",\n".join(parts) + "\n" + select if parts else select


def _summary() -> str:
    abnormal = """case base_name when 'click' then lab_value < 20.0 when 'error' then lab_value < 30.0
      when 'purchase' then lab_value < 10.0 when 'signup' then lab_value > 90.0
      when 'view' then lab_value < 15.0 end"""
    return f"""summary as (
  select date, base_name, count(*) as total_n, count(*) - count(lab_value) as missing_n,
    count(*) filter (where {abnormal}) as abnormal_n,
    round(min(lab_value), 6) as min, {r6('quantile_cont(lab_value, 0.25)', 'q25')},
    {r6('quantile_cont(lab_value, 0.5)', 'median')}, {r6('quantile_cont(lab_value, 0.75)', 'q75')},
    round(max(lab_value), 6) as max, round(avg(lab_value), 6) as mean,
    round(stddev_samp(lab_value), 6) as sd
  from event_values group by date, base_name)"""


def _scaled(fit: str, scale: bool) -> str:
    def z(c: str) -> str:
        centred = f"{c} - avg_{c}"
        return r6(f"({centred}) / nullif(sd_{c}, 0)" if scale else centred, c)

    stats = ", ".join(f"avg({c}) as avg_{c}, stddev_samp({c}) as sd_{c}" for c in PREDICTORS)
    return _query(
        [*TRAINING_PARTS, f"fit as (select {stats} from ({fit}))"],
        f"select date, {', '.join(z(c) for c in PREDICTORS)}, plt_used from training, fit",
    )


def _windows() -> str:
    """Complete rows of every training window: 200 rows, smoothed columns from the seventh on."""
    known = " and ".join(f"t.{c} is not null" for c in PREDICTORS)
    return f"""placed as (
  select *, row_number() over (order by date) as rn,
    case when count(*) over ahead = 3 then sum(plt_used) over ahead end as y3
  from training window ahead as (order by date rows between 1 following and 3 following)),
fits as (
  select p.date as model_date, p.rn from placed p join ages a on p.date = a.date
  where reason is not null and p.rn > 200),
used_rows as (
  select f.model_date, t.* from fits f join placed t
    on t.rn between f.rn - 194 and f.rn - 3 and t.y3 is not null and {known})"""


BY_SITE = "partition by site"


def _site_training() -> str:
    """The training table of every site: regions are sites, nations their wards."""
    features = ", ".join(
        f"cast(coalesce(sum(nq) filter (where base_name = '{b}'), 0) as bigint) as {b}_Nq" for b in LINE_LABS
    )
    smoothed = ", ".join(f"{trailing('avg', f'{b}_Nq', 7, BY_SITE)} as {b}_Nq" for b in LINE_LABS)
    beds = ", ".join(f"cast(count(*) filter (where ward = '{w}') as bigint) as {w}" for w in WARDS)
    days = ", ".join(f"cast(isodow(l.date) = {k} as integer) as {d}" for k, d in enumerate(WEEKDAYS, 1))
    return f"""stays as (
  select o_orderkey, cast(o_orderdate as date) as date, n_regionkey as site,
    'N' || cast(c_nationkey as varchar) as ward
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
site_lines as (
  select site, cast(l_shipdate as date) as date, l_returnflag as type,
    l_returnflag || l_linestatus as base_name, l_quantity as lab_value
  from lineitem join stays on l_orderkey = o_orderkey),
thresholds as (
  select site, date, base_name, case base_name when 'AO' then 12.0 when 'RF' then 25.0
    else quantile_cont(lab_value, 0.25) end as threshold
  from site_lines group by site, date, base_name),
site_counts as (
  select l.site as site, l.date as date, l.base_name as base_name,
    case when l.base_name = 'NO' then count(*) filter (where lab_value >= threshold)
      else count(*) filter (where lab_value < threshold) end as nq
  from site_lines l join thresholds t using (site, date, base_name)
  group by l.site, l.date, l.base_name),
site_features as (select site, date, {features} from site_counts group by site, date),
site_smoothed as (select site, date, {smoothed} from site_features),
site_census as (select site, date, {beds} from stays group by site, date),
site_lagged as (
  select site, date, used as plt_used, {trailing('avg', 'used', 7, BY_SITE)} as seven_lag
  from (select site, date, count(*) as used from site_lines where type = 'R' group by site, date)),
training as (
  select l.site, l.date, {days}, seven_lag, {', '.join(f'{b}_Nq' for b in LINE_LABS)},
    {', '.join(WARDS)}, plt_used
  from site_lagged l join site_smoothed using (site, date) join site_census using (site, date))"""


def _with_site(parts: str) -> str:
    """Fragments on one series, for a series per site."""
    return (
        parts.replace("over (order by date", f"over ({BY_SITE} order by date")
        .replace("as (order by date", f"as ({BY_SITE} order by date")
        .replace("select date,", "select site, date,")
    )


def _site_windows() -> str:
    known = " and ".join(f"t.{c} is not null" for c in PREDICTORS)
    return f"""placed as (
  select *, row_number() over ({BY_SITE} order by date) as rn,
    case when count(*) over ahead = 3 then sum(plt_used) over ahead end as y3
  from training
  window ahead as ({BY_SITE} order by date rows between 1 following and 3 following)),
fits as (
  select site, date as model_date, rn from placed join ages using (site, date)
  where reason is not null and rn > 200),
used_rows as (
  select f.model_date, t.* from fits f join placed t
    on t.site = f.site and t.rn between f.rn - 194 and f.rn - 3 and t.y3 is not null and {known})"""


def oracle_sql() -> dict[str, str]:
    ledger_out = ", ".join(r6(c, c) for c in LEDGER_COLUMNS)
    shown = f"""shown as (
  select *, r1_adj + r2_adj as remaining,
    row_number() over (partition by site order by date desc) as back
  from ledger where i > {START})"""
    hist = """measures as (
  select 'remaining' as measure, r1_adj + r2_adj as value from ledger where i > 10
  union all select 'wasted', w_adj from ledger where i > 10),
ranges as (select measure, min(value) as lo, max(value) as hi from measures group by measure)"""
    return {
        "daily_usage": _query([USAGE], "select date, used from usage"),
        "usage_seven_lag": _query(
            [USAGE], f"select date, used, {r6(trailing('avg', 'used', 7), 'seven_lag')} from usage"
        ),
        "usage_three_day_sum": _query(
            [USAGE],
            f"select date, used, cast({trailing('sum', 'used', 3)} as bigint) as ms3 from usage",
        ),
        "three_day_target": _query(
            [USAGE],
            """select date, used, cast(case when count(used) over f = 3 then sum(used) over f end
            as bigint) as y3 from usage
            window f as (order by date rows between 1 following and 3 following)""",
        ),
        "site_usage": _query([SITE_USAGE], "select site, date, used from site_usage"),
        "site_usage_seven_lag": _query(
            [SITE_USAGE],
            "select site, date, used, "
            + r6(trailing("avg", "used", 7, "partition by site"), "seven_lag")
            + " from site_usage",
        ),
        "weekday_one_hot": _query(
            [USAGE],
            "select date, "
            + ", ".join(f"cast(isodow(date) = {k} as integer) as {d}" for k, d in enumerate(WEEKDAYS, 1))
            + " from usage",
        ),
        "last_days_of_usage": _query(
            [USAGE], "select date, used from usage order by date desc limit 201"
        ),
        "first_days_of_usage": _query(
            [USAGE], "select date, used from usage order by date limit 200"
        ),
        "lab_clean": _query(
            [EVENT_VALUES],
            "select distinct date, base_name, round(lab_value, 6) as lab_value from event_values",
        ),
        "lab_missing_values": _query(
            [EVENT_VALUES],
            """select date, base_name, ord_value from event_values where lab_value is null
            and not coalesce(regexp_matches(ord_value, '^<0.1'), false)""",
        ),
        "lab_summary": _query([EVENT_VALUES, _summary()], "select * from summary"),
        "lab_summary_latest_day": _query(
            [EVENT_VALUES, _summary()],
            "select * exclude (date) from summary where date = (select max(date) from event_values)",
        ),
        "event_threshold_counts": _query(
            [
                EVENT_VALUES,
                "cleaned as (select distinct date, base_name, lab_value from event_values)",
                threshold_counts(
                    "cleaned", "event_counts", {"purchase": 50.0, "view": 40.0}, "signup"
                ),
            ],
            "select * from event_counts",
        ),
        "event_row_threshold_counts": _query(
            [
                EVENT_VALUES,
                threshold_counts(
                    "event_values", "event_counts", {"purchase": 50.0, "view": 40.0}, "signup"
                ),
            ],
            "select * from event_counts",
        ),
        "lab_threshold_counts": _query([LINE_VALUES, LINE_COUNTS], "select * from line_counts"),
        "lab_counts_wide": _query(
            [LINE_VALUES, LINE_COUNTS],
            "select date, "
            + ", ".join(
                f"cast(coalesce(sum({src}) filter (where base_name = '{b}'), 0) as bigint) as {b}_{out}"
                for b in LINE_LABS for src, out in (("n", "N"), ("nq", "Nq"))
            )
            + " from line_counts group by date",
        ),
        "lab_features_wide": _query([LINE_VALUES, LINE_COUNTS, FEATURES], "select * from features"),
        "lab_features_smoothed": _query(
            [LINE_VALUES, LINE_COUNTS, FEATURES, SMOOTHED],
            "select date, " + ", ".join(r6(f"{b}_Nq", f"{b}_Nq") for b in LINE_LABS) + " from smoothed",
        ),
        "census_counts": _query([CENSUS], "select date, ward, n from census"),
        "census_wide": _query([CENSUS, CENSUS_WIDE], "select * from census_wide"),
        "census_day_long": _query(
            [CENSUS, CENSUS_WIDE,
             "latest as (select * exclude (date) from census_wide "
             "where date = (select max(date) from census_wide))"],
            "select ward, cast(n as integer) as n from (unpivot latest on *  into name ward value n)",
        ),
        "missing_wards": _query(
            [CENSUS],
            "select ward from (values "
            + ", ".join(f"('{w}')" for w in [*WARDS, "X-ICU", "Y-STEPDOWN"])
            + ") v(ward) except select ward from census",
        ),
        "inventory_buckets": _query([INVENTORY, BUCKETS], "select * from buckets"),
        "inventory_expired_flags": _query(
            [INVENTORY],
            """select date, type, days_to_expire, days_to_expire <= 0 as already_expired
            from stock where type = 'R'""",
        ),
        "training_table": _query(
            TRAINING_PARTS,
            f"select date, {', '.join(WEEKDAYS)}, {r6('seven_lag', 'seven_lag')}, "
            + ", ".join(r6(f"{b}_Nq", f"{b}_Nq") for b in LINE_LABS)
            + f", {', '.join(WARDS)}, plt_used from training",
        ),
        "incomplete_dates": _query(
            [USAGE, LINE_VALUES, CENSUS],
            """select date, 'labs' as missing_feed from usage
               where date not in (select date from line_values)
               union all
               select date, 'census' from usage where date not in (select date from census)""",
        ),
        "scaler_fit": _query(
            TRAINING_PARTS,
            " union all ".join(
                f"select '{c}' as predictor, round(avg({c}), 6) as center, "
                f"round(stddev_samp({c}), 6) as scale from training"
                for c in PREDICTORS
            ),
        ),
        "scaler_apply": _scaled("select * from training order by date limit 200", True),
        "scaler_center_only": _scaled("select * from training", False),
        "rolling_scaler": _query(
            [*TRAINING_PARTS, ROLLING],
            f"select date, predictor, {r6('center', 'center')}, {r6('scale', 'scale')} from rolling",
        ),
        "site_training_table": _query(
            [_site_training()],
            f"select site, date, {', '.join(WEEKDAYS)}, {r6('seven_lag', 'seven_lag')}, "
            + ", ".join(r6(f"{b}_Nq", f"{b}_Nq") for b in LINE_LABS)
            + f", {', '.join(WARDS)}, plt_used from training",
        ),
        "site_rolling_scaler": _query(
            [_site_training(), _with_site(ROLLING)],
            f"select site, date, predictor, {r6('center', 'center')}, {r6('scale', 'scale')} from rolling",
        ),
        "site_forecast_windows": _query(
            [_site_training(), _with_site(runs("training")), _site_windows()],
            " union all ".join(
                f"select site, model_date, count(*) as n, cast(sum(y3) as double) as target_sum, "
                f"'{c}' as predictor, round(sum({c}), 6) as total from used_rows group by site, model_date"
                for c in PREDICTORS
            ),
        ),
        "model_age_ledger": _query(
            [USAGE, runs("usage")],
            "select date, age_before, reason is not null as retrain, reason from ages",
        ),
        "last_scaler_asof": _query(
            [*TRAINING_PARTS, ROLLING, runs("training"),
             """in_force as (
  select r.date, predictor,
    last_value(case when reason is not null then {'d': r.date, 'c': center, 's': scale} end ignore nulls)
      over (partition by predictor order by r.date rows between unbounded preceding and current row) as m
  from rolling r join ages a on r.date = a.date)"""],
            """select date, predictor, m.d as fitted_on, round(m.c, 6) as center,
            round(m.s, 6) as scale from in_force""",
        ),
        "accumulate_counts": _query([batch(0), batch(1), ACCUMULATED], "select * from accumulated"),
        "late_rows_effect": _query(
            [batch(0), batch(1), ACCUMULATED],
            """select a.date, a.used, b.used as used_before
            from accumulated a join batch0 b on a.date = b.date where a.used > b.used""",
        ),
        "multi_date_increments": _query(
            [USAGE],
            """select cast(date_trunc('week', date) as date) as increment,
            count(distinct date) as n_dates from usage group by 1 having count(distinct date) > 1""",
        ),
        "prediction_vs_usage": _query(
            [USAGE, DAYS], f"select date, plt_used, {r6('t_pred', 't_pred')} from days"
        ),
        "order_ledger": _query(SITE_LEDGER, f"select site, date, alert, {ledger_out} from ledger"),
        "low_stock_alerts": _query(
            SITE_LEDGER,
            f"select site, date, {r6('r1', 'r1')}, {r6('r2', 'r2')} from ledger where alert",
        ),
        "prediction_report": _query(
            [USAGE, DAYS, INVENTORY, BUCKETS, LEDGER],
            'select l.date, alert as "Alert", '
            + ", ".join(r6(f"l.{c}", label) for c, label in REPORT_NAMES)
            + ', b.count as "Inv. count", b.r1 as "Inv. expiring in 1 day", '
            'b.r2 as "Inv. expiring in 2 days", b.r3_plus as "Inv. expiring in 2+ days" '
            "from ledger l left join buckets b on l.date = b.date",
        ),
        "adjusted_orders": _query(
            SITE_LEDGER,
            "select site, date, "
            + ", ".join(
                f"cast(trunc({c}) as integer) as {c}"
                for c in ["plt_used", "t_adj", "r1_adj", "r2_adj", "w_adj", "x_adj", "s_adj"]
            )
            + " from ledger",
        ),
        "actual_vs_remaining": _query(
            [*SITE_LEDGER, shown],
            """select site, date, 'actual' as type, round(plt_used, 6) as value from shown
               where back <= 200 and plt_used is not null
               union all
               select site, date, 'remaining', round(remaining, 6) from shown
               where back <= 200 and remaining is not null""",
        ),
        "remaining_histogram": _query(
            [*SITE_LEDGER, hist],
            """select m.measure, cast(least(floor(coalesce((value - lo) * 100 / nullif(hi - lo, 0), 0)), 99) + 1
               as integer) as bin, count(*) as n
            from measures m join ranges r on m.measure = r.measure
            where value is not null group by 1, 2""",
        ),
        "forecast_windows": _query(
            [*TRAINING_PARTS, runs("training"), _windows()],
            " union all ".join(
                f"select model_date, count(*) as n, cast(sum(y3) as double) as target_sum, "
                f"'{c}' as predictor, round(sum({c}), 6) as total from used_rows group by model_date"
                for c in PREDICTORS
            ),
        ),
        "forecast_gradient": _query(
            [*TRAINING_PARTS, runs("training"), _windows()],
            "select model_date, false as off_optimum from fits",
        ),
        "usage_as_of": _query(
            [batch(0), batch(1)],
            """select date, arrival, cast(sum(used) over (partition by date order by arrival) as bigint)
              as used
            from (select *, 1 as arrival from batch0 union all select *, 2 from batch1)""",
        ),
        "windows_as_known": """
            with parts as (
              select date, cast(floor((date + late - date '1992-01-01') / 7) as integer) as run,
                count(*) as n
              from (select cast(l_shipdate as date) as date,
                  5 * cast(coalesce(l_orderkey % 3, 0) as integer) as late
                from lineitem where l_returnflag = 'R')
              group by 1, 2),
            runs as (select unnest(range(0, (select max(run) from parts) + 1)) as run),
            known as (
              select r.run, date, cast(sum(n) as bigint) as used
              from runs r join parts p on p.run <= r.run group by 1, 2)
            select cast(run as integer) as run, date, used,
              row_number() over (partition by run order by date desc) as back
            from known qualify back <= 10""",
        "file_stamps": _query(
            ["""stamped as (
  select o_orderkey, cast(cast(o_orderdate as date) as timestamp) + to_hours(o_orderkey % 24)
    + to_minutes(o_custkey % 60) + to_seconds(o_orderkey % 60) as moment from orders)"""],
            """select o_orderkey, strftime(moment, '%Y-%m-%d %H:%M:%S') as slash,
            strftime(moment, '%Y-%m-%d %H:%M:%S') as dash from stamped""",
        ),
        "file_name_parts": """
            select o_orderkey, cast(cast(o_orderdate as date) - 1 as date) as snapshot,
              cast(o_orderdate as date) as day,
              'Report_Daily' || strftime(o_orderdate, '%Y-%m-%d') || '-08-01-54-summary' as report
            from orders""",
        "expiry_times": """
            select o_orderkey, case when o_custkey % 10 <> 0 and o_orderkey % 25 <> 24 then
              strftime(cast(cast(o_orderdate as date) as timestamp) + to_hours(o_orderkey % 25)
                + to_minutes(45), '%Y-%m-%d %H:%M:%S') end as expiry_time
            from orders""",
        "lab_counts_without_totals": _query(
            [LINE_VALUES, LINE_COUNTS],
            "select date, "
            + ", ".join(
                f"cast(coalesce(sum(nq) filter (where base_name = '{b}'), 0) as bigint) as {b}_Nq"
                for b in LINE_LABS
            )
            + " from line_counts group by date",
        ),
    }
