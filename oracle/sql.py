"""Statements: shared common table expressions, then one SELECT per query.

Written from the report rules (NULL matches NULL in joins and counts once as a distinct value, percentages
round half to even, weeks start on Sunday), not from the Spark code.
"""

from __future__ import annotations

import math

AS_OF, SINCE, SERVICE = "date '2024-01-31'", "date '2024-01-15'", "'1-URGENT'"


def _nd(x: str) -> str:
    """Distinct values with NULL counted once."""
    return f"cast(count(distinct {x}) + coalesce(max(case when {x} is null then 1 else 0 end), 0) as bigint)"


def _eq(a: str, b: str) -> str:
    return f"{a} is not distinct from {b}"


def _pct(n: str, d: str, digits: int) -> str:
    return f"round_even(cast({n} as double) / nullif({d}, 0) * 100, {digits})"


def _code(prefix: str, key: str, width: int = 12) -> str:
    digits = f"cast({key} as varchar)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits}))::integer, '0'))"


# Region labels.
_REGION = (
    "case r_regionkey when 0 then 'London' when 1 then 'North West' when 2 then 'Midlands' "
    "when 3 then 'South East' when 4 then 'East Of England' end"
)
_K = "cast(regexp_extract(props, '([0-9]+)', 1) as integer)"
_CONTACT = f"""
  case when k >= 97 then null else stp end as icb_code,
  case when k between 60 and 69 then null else c_name end as name,
  concat('0', cast(event_id as varchar)) as phone,
  {_code("L", "c_nationkey", 2)} as lpc_code,
  case when c_nationkey = 3 then null else c_mktsegment end as lpc_name"""
_DAY = "case when k between 50 and 52 then null else d end"
_OPTED = "case when k = 40 then null else value > 15 end"

# Common table expressions in dependency order; DuckDB evaluates only those a statement reaches.
CTES = {
    "geo": f"""
select n_nationkey, n_name, n_regionkey,
  case when n_nationkey = 24 then 'Q62' when n_nationkey = 23 then 'QRV'
       else {_code("Q", "n_nationkey", 2)} end as stp,
  case when n_nationkey = 7 then null else concat('Y', cast(r_regionkey as varchar)) end as region_code,
  case when n_nationkey = 7 then null else {_REGION} end as region_name
from nation join region on n_regionkey = r_regionkey""",
    "provider": "select * from customer join geo on c_nationkey = n_nationkey",
    "ref_contractor": f"""
select {_code("F", "c_custkey")} as fcode,
  case when c_acctbal < -500 then 'Appliance' else 'Pharmacy' end as contractor_type,
  case when c_mktsegment = 'MACHINERY' then 'DAC' when c_acctbal between 0 and 300 then null
       else 'Community' end as contract_type,
  stp,
  case when n_nationkey = 12 and c_acctbal < 2000 then 'Y0' else region_code end as region_code,
  case when n_nationkey = 12 and c_acctbal < 2000 then 'London' else region_name end as region_name,
  case when c_acctbal > 9200 then date '2001-01-01' end as end_date
from provider""",
    "pharm_list": f"""
select distinct {_code("F", "c_custkey")} as fcode,
  cast(date_trunc('year', o_orderdate) as date) as snapshot_month,
  case when c_acctbal < -400 then null else {_code("PC", "(c_custkey // 2) * 22")} end as postcode,
  case when n_nationkey = 11 then null else stp end as stp_code,
  concat('Area ', cast(c_nationkey as varchar)) as icb_name, c_mktsegment as hwb, c_name as trading_name,
  concat('Group ', c_mktsegment) as organisation_name
from orders join provider on o_custkey = c_custkey""",
    "hundred_hour": f"""
select {_code("F", "c_custkey")} as fcode,
  case when c_mktsegment = 'HOUSEHOLD' and c_nationkey <> 15 then 'Yes' else 'No' end as hundred_hour
from customer""",
    "icb_short": """
select case when n_nationkey = 5 then null else stp end as icb_code,
  case when n_nationkey = 14 then null else n_name end as short_icb_name
from geo""",
    "icb_label": """
select icb_code, short_icb_name,
  concat(coalesce(icb_code, 'NA'), ': ', coalesce(short_icb_name, 'NA')) as icb
from icb_short""",
    "boundaries": """
select case when n_nationkey = 9 then null else stp end as icb_code,
  case when n_nationkey = 16 then null else n_name end as icb_name,
  concat('{"type":"Polygon","coordinates":[[[', n_nationkey, ',1.5],[2,', n_regionkey, '],[0,-3]]]}') as geometry
from geo""",
    "event": f"""
select event_id, event_type, value, cast(ts as date) as d, {_K} as k, user_id * 10 + event_id % 10 as ckey
from events""",
    "signup_rows": "select * from event join provider on ckey = c_custkey",
    "pharm1st": f"""
select case when k = 41 then null else {_code("F", "ckey")} end as ods_code, {_OPTED} as opted_in,
  {_DAY} as opt_in_date, case when k < 10 then null else k < 70 end as registered_for_cpcs, {_CONTACT}
from signup_rows where event_type = 'signup'""",
    "oc_opt": f"""
select case when k = 41 then null else {_code("F", "ckey")} end as ods_code, {_OPTED} as opted_in,
  d as opt_in_date, {_CONTACT}
from signup_rows where event_type = 'purchase'""",
    "oc_reg": f"""
select {_code("F", "ckey")} as fcode, {_DAY} as reg_date, {_CONTACT}
from signup_rows where event_type = 'click'""",
    "oc_dereg": f"""
select {_code("F", "ckey")} as ods_code, d as date_dereg, d - 30 as date_notice,
  case when k >= 95 then null else d + k end as service_end,
  cast(null as varchar) as icb, cast(null as varchar) as area
from event where event_type = 'error'""",
    "bp_reg": f"""
select case when k = 42 then null else {_code("F", "ckey")} end as fcode, {_DAY} as reg_date,
  case when k >= 97 then null else stp end as icb_code
from signup_rows where event_type = 'view'""",
    "regs": f"""
select {_code("F", "o_custkey")} as fcode, o_orderpriority as service,
  cast(date_trunc('year', o_orderdate) as date) as date_reported,
  case when o_totalprice < 20000 then null else cast(o_orderdate as date) end as registration_date
from orders""",
    "deregs": f"""
select {_code("F", "o_custkey")} as fcode, o_orderpriority as service,
  cast(date_trunc('year', o_orderdate) as date) as date_reported,
  case when o_totalprice > 250000 then cast(o_orderdate as date) end as re_registration_date
from orders where o_orderstatus = 'F'""",
    "postcodes": f"""
select {_code("PC", "o_orderkey")} as postcode,
  case when o_totalprice < 15000 then null else floor(100000 + o_totalprice) end as easting,
  case when o_totalprice < 15000 then null
       else cast(50000 + o_orderkey * 6007 % 900000 as double) end as northing
from orders""",
    "contractor": """
select distinct fcode, stp, region_code, region_name, contract_type
from ref_contractor where end_date is null and contractor_type = 'Pharmacy'""",
    "roster": f"""
select p.fcode, p.snapshot_month, p.postcode,
  case when p.stp_code = 'Q62' then 'QRV' else p.stp_code end as stp_code,
  p.icb_name, p.hwb, p.trading_name, p.organisation_name, h.hundred_hour,
  case when c.stp = 'Q62' then 'QRV' else c.stp end as stp,
  c.region_code, coalesce(c.region_name, 'Region Unknown') as region_name, c.contract_type,
  i.short_icb_name, i.icb
from pharm_list p
left join hundred_hour h on {_eq("p.fcode", "h.fcode")}
left join contractor c on {_eq("p.fcode", "c.fcode")}
left join icb_label i on {_eq("case when p.stp_code = 'Q62' then 'QRV' else p.stp_code end", "i.icb_code")}
where p.snapshot_month = (select max(snapshot_month) from pharm_list) and c.contract_type <> 'DAC'""",
    "icb_totals": f"""
select t.icb_code, i.short_icb_name, i.icb, t.total_contractors
from (select stp as icb_code, {_nd("fcode")} as total_contractors from roster group by stp) t
left join icb_label i on {_eq("t.icb_code", "i.icb_code")}""",
    "icb_totals_100": f"""
select stp as icb_code, {_nd("fcode")} as total_100_hour
from roster where hundred_hour = 'Yes' group by stp""",
    "oc": f"""
select ods_code, opted_in, opt_in_date, icb_code, name, phone, lpc_code, lpc_name from oc_opt
union all
select r.fcode, true, r.reg_date, r.icb_code, r.name, r.phone, r.lpc_code, r.lpc_name
from oc_reg r
left join (select distinct ods_code, service_end from oc_dereg where service_end <= {AS_OF}) x
  on {_eq("r.fcode", "x.ods_code")}
where r.reg_date >= {SINCE} and x.service_end is null""",
    "bp": f"""
select b.fcode, b.reg_date, b.icb_code, r.snapshot_month
from bp_reg b left join roster r on {_eq("b.fcode", "r.fcode")}""",
    "latest_regs": f"""
select fcode, service, date_reported, registration_date from regs
where service = {SERVICE} and date_reported = (select max(date_reported) from regs where service = {SERVICE})""",
    "latest_deregs": f"""
select distinct fcode, 1 as dereg from deregs
where service = {SERVICE} and re_registration_date is null
  and date_reported = (select max(date_reported) from deregs where service = {SERVICE})""",
    "signups": f"""
select l.service, l.date_reported, l.registration_date, r.*
from latest_regs l join roster r on {_eq("l.fcode", "r.fcode")}
where not exists (select 1 from latest_deregs d where {_eq("d.fcode", "l.fcode")})""",
    "full_join": f"""
select coalesce(p.ods_code, s.fcode) as fcode, p.opt_in_date, p.registered_for_cpcs, p.icb_code as list_icb,
  s.service, s.registration_date,
  p.opt_in_date is not null as opt_in, s.registration_date is not null as check_reg
from pharm1st p full join (select fcode, service, registration_date from signups) s
  on {_eq("p.ods_code", "s.fcode")}""",
    "reconciled": f"""
select f.fcode, f.opt_in_date, f.registered_for_cpcs, f.service, f.registration_date, f.opt_in, f.check_reg,
  f.registered_for_cpcs <> f.check_reg as mismatch,
  r.snapshot_month, r.postcode, r.stp_code, r.icb_name, r.hwb, r.trading_name, r.organisation_name,
  r.hundred_hour, r.stp, r.region_code, r.region_name, r.contract_type, r.short_icb_name, r.icb,
  coalesce(f.list_icb, r.stp) as icb_code
from full_join f left join roster r on {_eq("f.fcode", "r.fcode")}""",
    "reconcile_icb": f"""
select a.icb_code, a.signed_not_opted,
  {_pct("a.signed_not_opted", "t.total_contractors", 0)} as pct_signed_not_opted,
  b.opted_not_registered,
  {_pct("b.opted_not_registered", "t.total_contractors", 0)} as pct_opted_not_registered
from (select coalesce(icb_code, 'ICB unknown') as icb_code, {_nd("fcode")} as signed_not_opted
      from reconciled where not opt_in group by reconciled.icb_code) a
left join (select coalesce(icb_code, 'ICB unknown') as icb_code, {_nd("fcode")} as opted_not_registered
           from reconciled where mismatch = false and check_reg = false group by reconciled.icb_code) b
  on a.icb_code = b.icb_code
left join icb_totals t on a.icb_code = t.icb_code""",
    "p1_100": """
select p.* from pharm1st p
where p.opted_in and exists (
  select 1 from roster r where r.hundred_hour = 'Yes' and r.fcode is not distinct from p.ods_code)""",
    "bp_new": f"select * from bp where reg_date >= {SINCE} and snapshot_month is not null",
    "national": f"""
select *, {_pct("pharm1st_opted_in", "total_contractors", 1)} as pct_pharm1st,
  {_pct("contraception_opted_in", "total_contractors", 1)} as pct_contraception,
  {_pct("pharm1st_100_hour", "total_100_hour", 1)} as pct_pharm1st_100_hour
from (select
  (select {_nd("fcode")} from roster) as total_contractors,
  (select {_nd("ods_code")} from pharm1st where opted_in) as pharm1st_opted_in,
  (select {_nd("ods_code")} from oc where opted_in) as contraception_opted_in,
  (select {_nd("fcode")} from bp_new) as bp_new,
  (select {_nd("fcode")} from roster where hundred_hour = 'Yes') as total_100_hour,
  (select {_nd("ods_code")} from p1_100) as pharm1st_100_hour)""",
    "region_of": "select distinct stp as icb_code, region_code, region_name from contractor",
    "card_all": f"""
select t.icb_code, t.short_icb_name, t.icb, g.region_code, g.region_name, t.total_contractors,
  a.n as pharm1st_opted_in, {_pct("a.n", "t.total_contractors", 1)} as pct_pharm1st,
  o.n as contraception_opted_in, {_pct("o.n", "t.total_contractors", 1)} as pct_contraception,
  b.n as bp_new, h.total_100_hour, c.n as pharm1st_100_hour,
  {_pct("c.n", "h.total_100_hour", 1)} as pct_pharm1st_100_hour
from icb_totals t
left join icb_totals_100 h on {_eq("t.icb_code", "h.icb_code")}
left join (select icb_code, {_nd("ods_code")} as n from pharm1st where opted_in group by icb_code) a
  on {_eq("t.icb_code", "a.icb_code")}
left join (select icb_code, {_nd("ods_code")} as n from p1_100 group by icb_code) c
  on {_eq("t.icb_code", "c.icb_code")}
left join (select icb_code, {_nd("ods_code")} as n from oc where opted_in group by icb_code) o
  on {_eq("t.icb_code", "o.icb_code")}
left join (select icb_code, {_nd("fcode")} as n from bp_new group by icb_code) b
  on {_eq("t.icb_code", "b.icb_code")}
left join region_of g on {_eq("t.icb_code", "g.icb_code")}""",
    "card": "select * from card_all where total_100_hour is not null",
    "regional": f"""
select case region_name when 'North East And Yorkshire' then 'NEY' when 'South West' then 'SW'
    when 'East Of England' then 'EoE' when 'North West' then 'NE' when 'South East' then 'SE'
    when 'Midlands' then 'Mids' else case when region_name is not null then 'LDN' end end as region,
  total_contractors, pharm1st_opted_in, {_pct("pharm1st_opted_in", "total_contractors", 1)} as pct_pharm1st,
  contraception_opted_in, {_pct("contraception_opted_in", "total_contractors", 1)} as pct_contraception,
  bp_new, total_100_hour, pharm1st_100_hour,
  {_pct("pharm1st_100_hour", "total_100_hour", 1)} as pct_pharm1st_100_hour
from (select region_name,
    cast(coalesce(sum(total_contractors), 0) as bigint) as total_contractors,
    cast(coalesce(sum(pharm1st_opted_in), 0) as bigint) as pharm1st_opted_in,
    cast(coalesce(sum(contraception_opted_in), 0) as bigint) as contraception_opted_in,
    cast(coalesce(sum(bp_new), 0) as bigint) as bp_new,
    cast(coalesce(sum(total_100_hour), 0) as bigint) as total_100_hour,
    cast(coalesce(sum(pharm1st_100_hour), 0) as bigint) as pharm1st_100_hour
  from card group by region_name)""",
    "detail": """
select c.region_name, coalesce(c.icb, 'ICB Unknown') as icb, c.total_contractors, c.pharm1st_opted_in,
  c.pct_pharm1st, r.signed_not_opted, r.pct_signed_not_opted, r.opted_not_registered,
  r.pct_opted_not_registered, c.contraception_opted_in, c.pct_contraception, c.bp_new, c.total_100_hour,
  c.pharm1st_100_hour, c.pct_pharm1st_100_hour
from card c left join reconcile_icb r on c.icb_code is not distinct from r.icb_code""",
    "trend": f"""
select week, {_nd("code")} as optin, service from (
  select opt_in_date - cast(dayofweek(opt_in_date) as integer) as week, ods_code as code,
    'Pharmacy First Opt-In' as service from pharm1st where opted_in
  union all
  select opt_in_date - cast(dayofweek(opt_in_date) as integer), ods_code, 'Contraception Opt-In'
  from oc where opted_in
  union all
  select reg_date - cast(dayofweek(reg_date) as integer), fcode, 'BP check service signup since 01Dec2023'
  from bp_new
  union all
  select opt_in_date - cast(dayofweek(opt_in_date) as integer), ods_code,
    'Pharmacy First Opt-In (100-hour phmarcy only)' from p1_100)
group by week, service""",
    "last_p1": "select strftime(max(opt_in_date), '%Y-%m-%d') as rm, "
    "case when count(*) = count(opt_in_date) then strftime(max(opt_in_date), '%Y-%m-%d') end as strict "
    "from pharm1st",
    "last_oc": "select strftime(max(opt_in_date), '%Y-%m-%d') as rm, "
    "case when count(*) = count(opt_in_date) then strftime(max(opt_in_date), '%Y-%m-%d') end as strict from oc",
    "bp_figures": f"""
select
  (select {_nd("fcode")} from bp) as total,
  (select {_nd("fcode")} from bp where snapshot_month is null) as invalid,
  (select {_nd("fcode")} from bp where snapshot_month is not null and reg_date < {SINCE}) as old_registrations,
  (select {_nd("fcode")} from bp_new) as new_registrations,
  (select case when count(*) = count(reg_date) then strftime(max(reg_date), '%Y-%m-%d') end from bp) as last_date""",
    "signup_figures": f"""
select a as valid_signups, b as mismatches, a + b as signup_valid
from (select (select {_nd("fcode")} from signups) as a, (select {_nd("fcode")} from reconciled where mismatch) as b)""",
    "located": "select * from postcodes",
    "points_p1": f"""
select r.fcode, coalesce(p.opted_in, false) as opted_in, p.registered_for_cpcs, p.opt_in_date, r.postcode,
  coalesce(p.name, r.trading_name) as name, p.phone,
  concat(coalesce(p.lpc_code, 'NA'), ': ', coalesce(p.lpc_name, 'NA')) as lpc,
  concat(coalesce(r.stp_code, 'NA'), ': ', coalesce(r.short_icb_name, 'NA')) as icb,
  r.region_name, r.trading_name, g.easting, g.northing
from roster r left join pharm1st p on {_eq("p.ods_code", "r.fcode")}
left join postcodes g on {_eq("r.postcode", "g.postcode")}""",
    "points_oc": f"""
select r.fcode, coalesce(p.opted_in, false) as opted_in, p.opt_in_date, r.postcode,
  coalesce(p.name, r.trading_name) as name, p.phone,
  concat(coalesce(p.lpc_code, 'NA'), ': ', coalesce(p.lpc_name, 'NA')) as lpc,
  concat(coalesce(r.stp_code, 'NA'), ': ', coalesce(r.short_icb_name, 'NA')) as icb,
  r.region_name, r.trading_name, g.easting, g.northing
from roster r left join oc p on {_eq("p.ods_code", "r.fcode")}
left join postcodes g on {_eq("r.postcode", "g.postcode")}""",
    "status_p1": """
select case when opted_in then 'opted_in' else 'not_opted_in' end as layer,
  case when not opted_in then 'Red' when registered_for_cpcs then 'Green'
       when registered_for_cpcs = false then 'Amber' end as colour,
  case when not opted_in then 1 when registered_for_cpcs then 1 when registered_for_cpcs = false then 2
       else 3 end as draw_order,
  fcode, name, phone, lpc, icb, region_name, opt_in_date, postcode, easting, northing
from points_p1 where postcode is not null and easting is not null""",
    "status_oc": """
select case when opted_in then 'opted_in' else 'not_opted_in' end as layer,
  case when opted_in then 'Green' else 'Red' end as colour, 1 as draw_order,
  fcode, name, phone, lpc, icb, region_name, opt_in_date, postcode, easting, northing
from points_oc where postcode is not null and easting is not null""",
}


def _reached(text: str) -> list[str]:
    """Names of the expressions a statement needs, in order."""
    import re

    need, todo = set(), [text]
    while todo:
        for word in set(re.findall(r"[a-z_0-9]+", todo.pop())):
            if word in CTES and word not in need:
                need.add(word)
                todo.append(CTES[word])
    return [name for name in CTES if name in need]


def _with(select: str) -> str:
    parts = [f"{name} as ({CTES[name].strip()})" for name in _reached(select)]
    return (f"with {', '.join(parts)} " if parts else "") + select


def _choropleth(table: str, value: str, title_head: str, last: str, breaks: bool = True) -> str:
    """Quantile classes by linear interpolation, limits rounded and made unique."""
    limits = ", ".join(f"round(quantile_cont(value, {i / 5}), 6)" for i in range(6))
    shown = ", array_to_string([printf('%.3f', x) for x in b], ',') as breaks" if breaks else ""
    return f"""
select icb_code, icb_name, value,
  case when value is not null then cast(least(len([x for x in b if x <= round(value, 6)]),
    greatest(len(b) - 1, 1)) as integer) end as class{shown},
  concat('{title_head}', coalesce({last}, 'NA')) as title
from (select d.*, q.b from (
    select t.icb_code, n.icb_name, t.{value} as value from {table} t join boundaries n
      on t.icb_code is not distinct from n.icb_code where n.icb_name is not null) d,
  (select list_sort(list_distinct([{limits}])) as b from (
    select t.{value} as value from {table} t join boundaries n
      on t.icb_code is not distinct from n.icb_code where n.icb_name is not null)) q)"""


def _grid_sql() -> str:
    """Published grid-to-geodetic steps: iterated latitude on Airy 1830, datum shift, iterated latitude on WGS84."""
    a, b, f0 = 6377563.396, 6356256.909, 0.9996012717
    e2, n = 1 - (b / a) ** 2, (a - b) / (a + b)
    lat0, lon0 = math.radians(49), math.radians(-2)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    terms = [-(3 / 2 * n - 9 / 16 * n**3), 15 / 16 * n**2 - 15 / 32 * n**4, -35 / 48 * n**3, 315 / 512 * n**4]
    at_origin = lat0 + sum(t * math.sin(2 * i * lat0) for i, t in enumerate(terms, 1))
    series = "phi" + "".join(f" + ({t!r}) * sin({2 * i} * phi)" for i, t in enumerate(terms, 1))
    arc = f"{radius * f0!r} * ({series} - {at_origin!r})"
    steps = [f"select postcode, easting as e, northing as n, (northing + 100000) / {a * f0!r} + {lat0!r} as phi from postcodes"]
    for _ in range(8):
        steps.append(f"select postcode, e, n, (n + 100000 - {arc}) / {a * f0!r} + phi as phi from ({{}})")
    steps.append(
        f"select *, {a * f0!r} / sqrt(1 - {e2!r} * sin(phi) ** 2) as nu, "
        f"{a * f0 * (1 - e2)!r} / (1 - {e2!r} * sin(phi) ** 2) ** 1.5 as rho, e - 400000 as de, tan(phi) as t, "
        "1 / cos(phi) as s from ({})"
    )
    steps.append("select *, nu / rho - 1 as eta2 from ({})")
    steps.append(
        "select postcode, phi - t / (2 * rho * nu) * de ** 2 "
        "+ t / (24 * rho * nu ** 3) * (5 + 3 * t ** 2 + eta2 - 9 * t ** 2 * eta2) * de ** 4 "
        "- t / (720 * rho * nu ** 5) * (61 + 90 * t ** 2 + 45 * t ** 4) * de ** 6 as lat, "
        f"{lon0!r} + s / nu * de - s / (6 * nu ** 3) * (nu / rho + 2 * t ** 2) * de ** 3 "
        "+ s / (120 * nu ** 5) * (5 + 28 * t ** 2 + 24 * t ** 4) * de ** 5 "
        "- s / (5040 * nu ** 7) * (61 + 662 * t ** 2 + 1320 * t ** 4 + 720 * t ** 6) * de ** 7 as lon from ({})"
    )
    steps.append(f"select postcode, lat, lon, {a!r} / sqrt(1 - {e2!r} * sin(lat) ** 2) as nu from ({{}})")
    steps.append(
        f"select postcode, nu * cos(lat) * cos(lon) as x, nu * cos(lat) * sin(lon) as y, nu * {1 - e2!r} * sin(lat) as z from ({{}})"
    )
    k = 1 - 20.4894e-6
    rx, ry, rz = (math.radians(v / 3600) for v in (0.1502, 0.2470, 0.8421))
    steps.append(
        f"select postcode, 446.448 + {k!r} * x - {rz!r} * y + {ry!r} * z as x, "
        f"-125.157 + {rz!r} * x + {k!r} * y - {rx!r} * z as y, 542.060 - {ry!r} * x + {rx!r} * y + {k!r} * z as z from ({{}})"
    )
    a2, b2 = 6378137.0, 6356752.314245
    w = 1 - (b2 / a2) ** 2
    steps.append(f"select postcode, x, y, z, sqrt(x * x + y * y) as p, atan2(z, sqrt(x * x + y * y) * {1 - w!r}) as phi from ({{}})")
    for _ in range(5):
        steps.append(
            f"select postcode, x, y, z, p, atan2(z + {w * a2!r} / sqrt(1 - {w!r} * sin(phi) ** 2) * sin(phi), p) as phi from ({{}})"
        )
    steps.append("select postcode, round(degrees(atan2(y, x)), 5) as lon, round(degrees(phi), 5) as lat from ({})")
    text = steps[0]
    for step in steps[1:]:
        text = step.format(text)
    return text


def statements() -> dict[str, str]:
    card = (
        "total_contractors, pharm1st_opted_in, pct_pharm1st, contraception_opted_in, pct_contraception, bp_new, "
        "total_100_hour, pharm1st_100_hour, pct_pharm1st_100_hour"
    )
    oc_cols = "total_contractors, contraception_opted_in, pct_contraception"
    # Heads of map titles.
    area = "% of contractors opted in to {} service at ICB Level as on "
    gap = "% of contractors signed up for CPCS but not opt in  to Pharmacy First at ICB Level as on "
    p1_head, oc_head = area.format("Pharmacy First"), area.format("Contraception")
    point = "Pharmacies opted in for {} Service as on "

    def narrative(pick: str) -> str:
        return f"""
select (select {pick} from last_p1) as last_pharm1st, n.pharm1st_opted_in, n.pct_pharm1st, n.pharm1st_100_hour,
  s.signup_valid, (select strftime(max(snapshot_month), '%Y-%m-%d') from roster) as roster_date,
  (select {pick} from last_oc) as last_contraception, n.contraception_opted_in, n.pct_contraception,
  b.last_date as last_bp, b.total as bp_total, b.invalid as bp_invalid, b.total - b.invalid as bp_valid,
  b.new_registrations as bp_new
from national n, bp_figures b, signup_figures s"""

    selects = {
        "latest_contractor": "select * from contractor",
        "roster_latest": "select * from roster",
        "total_contractors": f"select {_nd('fcode')} as total_contractors from roster",
        "total_100_hour": f"select {_nd('fcode')} as total_100_hour from roster where hundred_hour = 'Yes'",
        "icb_totals": "select * from icb_totals",
        "icb_totals_100_hour": "select * from icb_totals_100",
        "roster_date": "select strftime(max(snapshot_month), '%Y-%m-%d') as roster_date from roster",
        "active_deregistrations": f"select ods_code, service_end from oc_dereg where service_end <= {AS_OF}",
        "contraception_opt_ins": "select * from oc",
        "bp_registrations": "select * from bp",
        "bp_metrics": "select * from bp_figures",
        "latest_registrations": "select * from latest_regs",
        "latest_deregistrations": "select * from latest_deregs",
        "signup_valid": "select * from signups",
        "last_dates": "select (select strict from last_p1) as last_pharm1st, "
        "(select strict from last_oc) as last_contraception",
        "last_dates_na_rm": "select (select rm from last_p1) as last_pharm1st, "
        "(select rm from last_oc) as last_contraception",
        "reconcile": "select * from reconciled",
        "reconcile_evidence": "select fcode, registered_for_cpcs, opt_in, check_reg, mismatch, icb_code, stp, "
        "trading_name, organisation_name, region_name, region_code, min(registration_date) as registration_date "
        "from reconciled group by all",
        "signup_valid_count": "select * from signup_figures",
        "reconcile_by_icb": "select * from reconcile_icb",
        "reconcile_pharmacy_list": "select fcode, trading_name, organisation_name, region_name, region_code, "
        "coalesce(icb_code, 'ICB unknown') as icb_code from (select *, row_number() over (partition by fcode "
        "order by opt_in_date nulls last, registration_date nulls last, icb_code nulls last) as rn "
        "from reconciled where not opt_in) where rn = 1",
        "report_pharmacy_level": "select fcode, trading_name, organisation_name, region_name, region_code, "
        "coalesce(icb_code, 'ICB unknown') as icb_code from (select *, row_number() over (partition by fcode "
        "order by opt_in_date nulls last, registration_date nulls last, icb_code nulls last) as rn "
        "from reconciled where not opt_in) where rn = 1",
        "national_scorecard": "select * from national",
        "headline_values": "select pharm1st_opted_in, pharm1st_100_hour, pct_pharm1st, contraception_opted_in, "
        "pct_contraception from national",
        "icb_scorecard": "select * from card",
        "icb_scorecard_all_areas": "select * from card_all",
        "icb_display": f"select icb, region_name, {card} from card",
        "regional_scorecard": "select * from regional",
        "region_icb_detail": "select * from detail",
        "region_icb_detail_one": "select * from detail where region_name = 'London'",
        "weekly_trend": "select * from trend",
        "trend_range": "select case when count(*) = count(week) then min(week) end as range_start, "
        "case when count(*) = count(week) then max(week) + 7 end as range_end from trend",
        "trend_range_na_rm": "select min(week) as range_start, max(week) + 7 as range_end from trend",
        "regional_long": "select region, 'pct_pharm1st' as service, pct_pharm1st as value from regional union all "
        "select region, 'pct_pharm1st_100_hour', pct_pharm1st_100_hour from regional union all "
        "select region, 'pct_contraception', pct_contraception from regional",
        "narrative": narrative("strict"),
        "narrative_na_rm": narrative("rm"),
        "icb_choropleth_pharm1st": _choropleth("card", "pct_pharm1st", p1_head, "(select rm from last_p1)"),
        "icb_choropleth_contraception": _choropleth("card", "pct_contraception", oc_head, "(select rm from last_oc)"),
        "icb_choropleth_signup_gap": _choropleth(
            "reconcile_icb", "pct_signed_not_opted", gap, "(select rm from last_p1)"
        ),
        "contractor_points_pharm1st": "select * from points_p1",
        "contractor_points_contraception": "select * from points_oc",
        "contractor_status_pharm1st": "select * from status_p1",
        "contractor_status_contraception": "select * from status_oc",
        "bng_to_wgs84": _grid_sql(),
        "map_titles": f"select concat('{p1_head}', a.rm) as area_pharm1st, concat('{oc_head}', o.rm) as "
        f"area_contraception, concat('{gap}', a.rm) as area_signup_gap, "
        f"concat('{point.format('Pharmacy First')}', a.rm) as points_pharm1st, "
        f"concat('{point.format('Contraception')}', o.rm) as points_contraception from last_p1 a, last_oc o",
        "parse_dates": "select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end "
        "as from_dmy, cast(o_orderdate as date) as from_ymd from orders",
        "week_floor": "select week, count(*) as n, strftime(max(d), '%Y-%m-%d') as last_day, "
        "strftime(week, '%B%Y') as month_stamp from (select cast(o_orderdate as date) as d, "
        "cast(o_orderdate as date) - cast(dayofweek(o_orderdate) as integer) as week from orders) group by week",
        "first_by": "select o_custkey, o_orderkey, o_orderpriority from (select *, row_number() over (partition by "
        "o_custkey order by cast(o_orderdate as date), o_orderkey) as rn from orders) where rn = 1",
        "landed_pharm1st": "select * from pharm1st",
        "landed_bp": "select * from bp_reg",
        "landed_dereg": "select * from oc_dereg",
        "landed_contraception_opt": "select * from oc_opt",
        "landed_contraception_reg": "select * from oc_reg",
        "landed_hundred_hour": "select * from hundred_hour",
        "landed_line_breaks": "select * replace (name || chr(10) || 'of ' || chr(34) || icb_code || chr(34) || ',' || chr(10) "
        "as name) from oc_opt",
        "membership_typed_keys": "select o_orderkey, custkey, exists (select 1 from (select case when c_custkey % 7 <> 0 "
        "then c_custkey end as listed from customer) where (listed % 2 = 0 or listed is null) "
        "and listed is not distinct from custkey) as in_list "
        "from (select o_orderkey, case when o_orderkey % 10 <> 0 then o_custkey end as custkey from orders)",
        "landed_postcodes": "select * from postcodes",
        "landed_boundaries": "select * from boundaries",
        "landed_boundaries_collection": "select * from boundaries",
        "stored_contractor": "select * from contractor",
        "stored_icb_short": "select * from icb_short",
        "stored_pharm_list": "select * from pharm_list where snapshot_month = (select max(snapshot_month) from pharm_list)",
        "reconcile_factors": "select ods_code as fcode, 'list' as side, opt_in_date, registered_for_cpcs, icb_code, "
        "cast(null as varchar) as service, cast(null as date) as registration_date, count(*) as n_rows, "
        "(select count(*) from signups s where s.fcode is not distinct from p.ods_code) as n_other "
        "from pharm1st p group by all union all "
        "select fcode, 'signed', cast(null as date), cast(null as boolean), cast(null as varchar), service, "
        "registration_date, count(*), (select count(*) from pharm1st p where p.ods_code is not distinct from s.fcode) "
        "from signups s group by all",
        "reconcile_counts": "select opt_in, check_reg, mismatch, count(*) as n_rows from reconciled group by all",
        "order_icb": "select row_number() over (order by pct_pharm1st desc nulls last, icb_code nulls last, "
        "region_name nulls last) as position, icb_code, region_name, pct_pharm1st from card",
        "order_regional": "select row_number() over (order by pct_pharm1st desc nulls last, region nulls last) as position, "
        "region, pct_pharm1st from regional",
        "order_region_detail": "select row_number() over (partition by region_name order by pct_pharm1st desc nulls last, "
        "icb nulls last, total_contractors nulls last, pharm1st_opted_in nulls last, contraception_opted_in nulls last) "
        "as position, region_name, icb, pct_pharm1st from detail",
        "report_manifest": " union all ".join(
            f"select '{name}' as \"table\", 'deck_2024-01-31/{name}' as folder, count(*) as n_rows from {table}"
            for name, table in (
                ("trend", "trend"),
                ("trend_range", "(select 1)"),
                ("headline", "(select 1)"),
                ("regional_long", "(select * from regional, range(3))"),
                ("map_pharm1st", "card t join boundaries n on t.icb_code is not distinct from n.icb_code where n.icb_name is not null"),
                ("map_contraception", "card t join boundaries n on t.icb_code is not distinct from n.icb_code where n.icb_name is not null"),
                ("map_signup_gap", "reconcile_icb t join boundaries n on t.icb_code is not distinct from n.icb_code where n.icb_name is not null"),
            )
        ),
        "report_national": "select * from national",
        "report_regional": "select * from regional",
        "report_icb": f"select icb, region_name, {card} from card",
        "report_by_region": "select * from detail",
        "report_map_layers": "select p.* exclude (easting, northing), g.lon, g.lat, "
        "case service || ' ' || colour when 'pharm1st Green' then 'Opted in to PharmFirst and also registered for CPCS' "
        "when 'pharm1st Amber' then 'Opted in to PharmFirst but not registered for CPCS' "
        "when 'pharm1st Red' then 'Not opted in to PharmFirst yet' "
        "when 'contraception Green' then 'Opted in to Contraception Service' "
        "when 'contraception Red' then 'Not opted in to Contraception Service yet' end as legend, "
        "row_number() over (partition by service, layer order by draw_order nulls last, fcode nulls last, "
        "opt_in_date nulls last, phone nulls last, name nulls last, p.postcode nulls last, easting nulls last, "
        "northing nulls last) as position from ("
        f"select 'pharm1st' as service, s.*, concat('{point.format('Pharmacy First')}', coalesce(cast(a.strict as varchar), 'NA')) as title "
        "from status_p1 s, last_p1 a union all "
        f"select 'contraception', s.*, concat('{point.format('Contraception')}', coalesce(cast(o.strict as varchar), 'NA')) from status_oc s, last_oc o) p "
        f"left join (select distinct * from ({_grid_sql()})) g on p.postcode = g.postcode",
        "report_folders": " union all ".join(
            f"select '{name}' as name, '{folder}' as folder, count(*) as n_rows from {table}"
            for name, folder, table in (
                ("National", "Pharm1st_OptIn_2024-01-31/National", "national"),
                ("Regional", "Pharm1st_OptIn_2024-01-31/Regional", "regional"),
                ("ICB", "Pharm1st_OptIn_2024-01-31/ICB", "card"),
                ("Pharmacy Level", "Pharm1st_OptIn_2024-01-31/Pharmacy_Level", "(select distinct fcode from reconciled where not opt_in)"),
                ("By region", "opt_in_by_region_2024-01-31", "detail"),
                ("Map layers", "opt_in_map_January2024", "(select fcode from status_p1 union all select fcode from status_oc)"),
            )
        ),
        "contraception_trend": "select * from trend where service = 'Contraception Opt-In'",
        "contraception_headline": "select contraception_opted_in, pct_contraception, "
        "(select strict from last_oc) as last_contraception from national",
        "contraception_regional": f"select region, {oc_cols} from regional",
        "contraception_icb": f"select region_name, icb, {oc_cols} from detail",
        "contraception_map": _choropleth("card", "pct_contraception", oc_head, "(select strict from last_oc)", False),
    }
    selects |= {
        "deck_trend": selects["weekly_trend"],
        "deck_trend_range": selects["trend_range_na_rm"],
        "deck_headline": selects["narrative_na_rm"],
        "deck_regional_long": selects["regional_long"],
        "deck_map_pharm1st": selects["icb_choropleth_pharm1st"],
        "deck_map_contraception": selects["icb_choropleth_contraception"],
        "deck_map_signup_gap": selects["icb_choropleth_signup_gap"],
    }
    return {name: _with(select.strip()) for name, select in selects.items()}
