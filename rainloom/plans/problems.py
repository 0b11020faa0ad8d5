"""Registered queries of the data-cleaning operators (problems 1 to 6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rainloom.functions import matching
from rainloom.operators import drift, nearby, rawlines, regular, spikes, unify
from rainloom.plans.sql import UNITS
from rainloom.sources.tables import read


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.implausible_readings(read(spark, d, "station_obs"), read(spark, d, "fcst_daily"), read(spark, d, "file_attrs")).select("tbl", "row_id")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return rawlines.failed_lines(read(spark, d, "station_lines"))


def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The readings of the valid lines."""
    return rawlines.loaded_readings(read(spark, d, "station_lines"))


def p2_errors(spark: SparkSession, d: str) -> DataFrame:
    """The lines that fail, with their reason and the offset of the character or field that does."""
    return rawlines.parse_lines(read(spark, d, "station_lines")).filter("at >= 0").select("line_id", F.col("status").alias("reason"), "at")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return unify.other_units(read(spark, d, "fcst_daily"), read(spark, d, "obs_daily"), read(spark, d, "file_attrs"))


def p3_forecasts(spark: SparkSession, d: str) -> DataFrame:
    """Forecast amounts in metres and millimetres."""
    return unify.convert_forecast(read(spark, d, "fcst_daily"), read(spark, d, "file_attrs")).select("fcst_id", "tp_m", "tp_daily_mm")


def p3_observations(spark: SparkSession, d: str) -> DataFrame:
    """Observed amounts in millimetres."""
    return unify.convert_observations(read(spark, d, "obs_daily"), read(spark, d, "file_attrs")).select("row_id", "precip_mm")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return regular.empty_slots(read(spark, d, "station_obs"), read(spark, d, "stations"))


def p4_series(spark: SparkSession, d: str) -> DataFrame:
    """The regular series with observed, filled and unsupported slots."""
    return regular.regularise(read(spark, d, "station_obs"), read(spark, d, "stations"))


def p4_hidden(spark: SparkSession, d: str) -> DataFrame:
    """How well observed slots kept from the factorisation are filled, per cadence."""
    return regular.hidden_error(read(spark, d, "station_obs"), read(spark, d, "stations"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return nearby.near_and_within(read(spark, d, "sites"), read(spark, d, "zone_edges"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.field_changes(read(spark, d, "station_catalog"))


def p6_unified(spark: SparkSession, d: str) -> DataFrame:
    """All records in degrees and metres."""
    return drift.unified(read(spark, d, "station_catalog")).select("record_id", "feed", "file_seq", "station", *[F.round(c, 6).alias(c) for c in drift.FIELDS])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p2_found, p2_loaded, p2_errors, p3_found, p3_forecasts, p3_observations, p4_found, p4_series, p4_hidden, p5_found, p6_found, p6_unified)
}

# The known names and unit endings of the fields, as in `functions.matching`; unlike the operator, the SQL goes by names alone.
_NAMES = " ".join(f"when n in ({', '.join(repr(a) for a in names)}) then '{f}'" for f, names in matching.ALIASES.items())
_ENDINGS = "|".join(sorted(matching.UNIT_ENDINGS))
_LEAVES = f"""doc as (select record_id, feed, file_seq, case when json_valid(payload) then payload end p from station_catalog),
l1 as (select record_id, feed, file_seq, e.key k, e.type t, e.value v from doc, json_each(p) e),
l2 as (select record_id, feed, file_seq, l1.k || '.' || e.key k, e.type t, e.value v from l1, json_each(case when l1.t = 'OBJECT' then l1.v end) e),
leaf as (select *, regexp_replace(lower(regexp_extract(k, '[^.]+$')), '[^a-z]+({_ENDINGS})$', '') n, case t when 'ARRAY' then 'array' when 'VARCHAR' then 'string' else 'number' end kind from (from l1 union all from l2) where t not in ('OBJECT', 'NULL')),
field as (select feed, file_seq, record_id, k, kind, v, case {_NAMES} end field from leaf)"""

_LINES = f"""head as (select file_name, regexp_replace(arg_min(raw, line_id), '^\\x{{FEFF}}', '') raw from station_lines where line_no = 1 group by 1),
known as (select file_name, raw, regexp_extract(raw, '^\\s*(?:"[^"]*"|[^",;\t]*?)\\s*([,;\t])', 1) d from head),
line as (select line_id, file_name, line_no, coalesce(nullif(d, ''), ',') d, regexp_replace(regexp_replace(regexp_replace(l.raw, '^\\x{{FEFF}}+', ''), '[\\r\\n]+$', ''), '\\x{{A0}}', ' ', 'g') t from station_lines l left join known using (file_name)),
form as (select *, case when d = chr(9) then '[ ]*' else '[ \\t]*' end b from line),
cell as (select line_id, file_name, line_no, d, t, regexp_full_match(t, '(?:' || b || '"(?:[^"]|"")*"' || b || '|[^"' || d || ']*)(?:' || d || '(?:' || b || '"(?:[^"]|"")*"' || b || '|[^"' || d || ']*))*') well,
  list_transform(string_split(regexp_replace(regexp_replace(t, '"([^"' || d || ']*)"', case when line_no > 4 then '\\1' else 'x' end, 'g'), '"(?:[^"]|"")*"', 'x', 'g'), d), lambda x: regexp_replace(x, '^[ \\t]+|[ \\t]+$', '', 'g')) f from form),
size as (select file_name, len(f) k from cell where line_no = 1 qualify row_number() over (partition by file_name order by line_id) = 1),
judged as (select line_id, c.file_name, f, case when not well then 'quoting' when len(f) <> k then 'columns' when not regexp_full_match(f[1], '[0-9]{{8}}') or try_strptime(f[1], '%Y%m%d') is null then 'time'
  when len(list_filter(f[2:], lambda x: not regexp_full_match(lower(x), 'na|nan||-(?:999|99|9999)(?:\\.0*)?|\\+?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:e[+-]?[0-9]+)?|-(?:0+\\.?0*|\\.0+)(?:e[+-]?[0-9]+)?'))) > 0 then 'prcp' else 'ok' end reason
  from cell c left join size using (file_name) where line_no > 4 and regexp_matches(t, '[^ \\t]'))"""

ORACLE: dict[str, str] = {
    "p2_found": f"with {_LINES} select line_id, reason from judged where reason <> 'ok'",
    "p2_loaded": f"""with {_LINES},
named as (select file_name, list_transform(regexp_extract_all(t, '(?:^|' || d || ')(' || b || '"(?:[^"]|"")*"' || b || '|[^"' || d || ']*)', 1), lambda x: regexp_replace(x, '^[ \\t]+|[ \\t]+$', '', 'g')) n from form where line_no = 1 qualify row_number() over (partition by file_name order by line_id) = 1),
v as (select line_id, judged.file_name, cast(strptime(f[1], '%Y%m%d') as date) as time, unnest(n[2:]) s, unnest(f[2:]) x from judged join named using (file_name) where reason = 'ok')
select line_id, file_name, time, case when s[1] = '"' then trim(replace(s[2:-2], '""', '"')) else s end station, case when not regexp_full_match(lower(x), 'na|nan||-(?:999|99|9999)(?:\\.0*)?') then abs(cast(ltrim(x, '+') as double)) end prcp from v""",
    "p3_found": f"""
with {UNITS}, v as (select 'fcst_daily' tbl, 'tp' field, fcst_id row_id, tp v, unit from fcst_daily join units using (file_id) where field = 'tp' union all select 'fcst_daily', 'tp_daily', fcst_id, tp_daily, unit from fcst_daily join units using (file_id) where field = 'tp_daily'
  union all select 'obs_daily', 'precip', row_id, precip, unit from obs_mm)
select tbl, field, row_id, unit from v where v is not null and not isnan(v) and unit <> case field when 'tp' then 'm' else 'mm' end""",
    "p3_forecasts": f"with {UNITS} select fcst_id, tp tp_m, tp_daily tp_daily_mm from fcst_mm",
    "p3_observations": f"with {UNITS} select row_id, precip precip_mm from obs_mm",
    "p6_found": f"""
with {_LEAVES},
one as (select feed, file_seq, field, arg_max(k, c) k, arg_max(kind, c) kind from (select feed, file_seq, field, k, kind, count(*) c from field where field is not null group by all) group by all),
file as (select feed, file_seq, row_number() over (partition by feed order by file_seq) r from (select distinct feed, file_seq from station_catalog where feed is not null and file_seq is not null)),
pair as (select b.feed, b.file_seq, f.field, x.k pk, x.kind pt, y.k qk, y.kind qt from file a join file b on a.feed = b.feed and b.r = a.r + 1, (values ('longitude'), ('latitude'), ('elevation')) f(field)
  left join one x on x.feed = a.feed and x.file_seq = a.file_seq and x.field = f.field left join one y on y.feed = b.feed and y.file_seq = b.file_seq and y.field = f.field)
select feed, file_seq, field, 'added' as change from pair where pk is null and qk is not null union all select feed, file_seq, field, 'removed' from pair where pk is not null and qk is null
union all select feed, file_seq, field, 'renamed' from pair where pk <> qk union all select feed, file_seq, field, 'retyped' from pair where pt <> qt""",
    "p4_found": """
with r as (
  select o.station, s.cadence_h, time_bucket(to_hours(s.cadence_h), o.time, timestamp '2000-01-01') as slot
  from station_obs o join (select station, min(cadence_h) cadence_h from stations where cadence_h between 1 and 24 group by 1) s using (station)
  where o.prcp is not null and not isnan(o.prcp) and o.prcp not in (-999, -99, -9999) and o.time is not null
), m as (select distinct station, cadence_h, date_trunc('month', slot) as month from r),
g as (select station, unnest(generate_series(month::timestamp, month + interval 1 month - interval 1 hour, to_hours(cadence_h))) as slot from m)
select g.station, strftime(g.slot, '%Y-%m-%d %H:%M') as slot from g left join (select distinct station, slot from r) r on g.station = r.station and g.slot = r.slot where r.slot is null""",
    "p5_found": """
with p as (select site_id, longitude x, latitude y from sites where longitude between 4 and 36 and latitude between -21 and 25),
n as (
  select a.site_id a, b.site_id b from p a join p b on floor(b.y / 0.0046e0) between floor(a.y / 0.0046e0) - 1 and floor(a.y / 0.0046e0) + 1 and floor(b.x / 0.0055e0) between floor(a.x / 0.0055e0) - 1 and floor(a.x / 0.0055e0) + 1
  where a.site_id < b.site_id
    and 2 * 6371.0e0 * asin(least(1.0e0, sqrt(pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2)))) <= 0.5e0
), z as (
  select site_id, adm0_a3, poly_id from p join zone_edges e on (e.y1 > p.y) <> (e.y2 > p.y) and p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
  group by all having count(*) % 2 = 1)
select 'near' as kind, a as key_a, cast(b as varchar) as key_b from n union all select distinct 'zone', site_id, adm0_a3 from z""",
}
