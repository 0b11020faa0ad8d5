"""Oracle SQL of the registered forecast queries, for DuckDB."""

from __future__ import annotations

from rainloom import config
from rainloom.functions.requests import box, cds_area


def _q(v: str, p: str) -> str:
    """Linear quantile `p` of the sorted list `v`."""
    at = f"((len({v})-1)*({p}))"
    a, b = f"{v}[cast(floor{at} as int)+1]", f"{v}[least(cast(floor{at} as int)+2, len({v}))]"
    g = f"({at}-floor{at})"
    return f"case when len({v}) > 0 then case when {g} >= 0.5e0 then {b}-({b}-{a})*(1-{g}) else {a}+({b}-{a})*{g} end end"


_INSIDE = "(e.y1 > {y}) <> (e.y2 > {y}) and {x} < (e.x2-e.x1)*({y}-e.y1)/(e.y2-e.y1)+e.x1"
_CUBE = f"""
cube as (select concat(l_returnflag,l_linestatus) model, s_nationkey cell_id, cast(l_linenumber % 5 as int) number, cast(year(l_shipdate) as int) as year, cast(month(l_shipdate) as int) period_id, sum(l_quantity) tp_daily
  from lineitem join supplier on l_suppkey = s_suppkey group by all),
span as (select min(year) a, max(year) b from cube),
frame as (select model, cell_id, cast(n as int) number, cast(y as int) as year, cast(p as int) period_id from (select distinct model, cell_id from cube), range(0,5) a(n), (select unnest(range(a, b + 1)) from span) b(y), range(1,13) c(p)),
acc as (select model, cell_id, number, year, period_id, coalesce(sum(tp_daily), 0.0e0) acc_mm from frame left join cube using (model, cell_id, number, year, period_id) group by all),
h as (select * from acc where year < (select b from span)), f as (select * from acc where year = (select b from span)),
place as (select distinct s_nationkey cell_id, 4.0e0 + 8.0e0 * (s_nationkey % 5) x, -21.0e0 + 11.5e0 * floor(s_nationkey / 5) y from supplier),
inside as (select distinct cell_id from (select cell_id, adm0_a3, poly_id from place join zone_edges e on {_INSIDE.format(x='x', y='y')} group by all having count(*) % 2 = 1)),
cz as (select place.cell_id, inside.cell_id is not null in_zone from place left join inside using (cell_id))"""
_ORDERS = """
o as (select c_nationkey cell_id, cast(month(o_orderdate) as int) period_id, cast(year(o_orderdate) as int) as year, sum(o_totalprice)/1000.0e0 acc_mm from orders join customer on o_custkey = c_custkey where year(o_orderdate) < (select b from span) group by all)"""
_NAMES = ['"prob_BN"', '"prob_NN"', '"prob_AN"', "prob_low20", "prob_high20", "prob_exceed_median"]


_KEYS = "model, cell_id, period_id"


def _limits(base: str) -> str:
    """Thresholds `lim` of the hindcasts `h`."""
    return f"""{base},
pooled as (select model, cell_id, period_id, coalesce(list_sort(list(acc_mm) filter (acc_mm is not null)), []) v, avg(acc_mm) clim_mean from h group by all),
lim as (select model, cell_id, period_id, {_q('v', '1/3')} lo3, {_q('v', '2/3')} up3, {_q('v', '1/5')} lo5, {_q('v', '4/5')} up5, {_q('v', '1/2')} med, clim_mean, coalesce(clim_mean < 1.0e0, false) dry_mask from pooled)"""


def _probs(base: str, keys: str) -> str:
    """Probabilities `probs` of the forecasts `f` by `keys`."""
    return f"""{_limits(base)},
probs as (select {keys}, sum(case when acc_mm < lo3 then 1 else 0 end)/cast(count(*) as double) "prob_BN", sum(case when acc_mm >= lo3 and acc_mm <= up3 then 1 else 0 end)/cast(count(*) as double) "prob_NN",
  sum(case when acc_mm > up3 then 1 else 0 end)/cast(count(*) as double) "prob_AN", sum(case when acc_mm < lo5 then 1 else 0 end)/cast(count(*) as double) prob_low20, sum(case when acc_mm > up5 then 1 else 0 end)/cast(count(*) as double) prob_high20,
  sum(case when acc_mm > med then 1 else 0 end)/cast(count(*) as double) prob_exceed_median from f join lim using (model, cell_id, period_id) group by all)"""


def _light(base: str, also: str = "") -> str:
    """Products `light` per model and their combination `multi`; `also` holds further keys of the forecasts, each with a comma before it."""
    keys = f"model, cell_id, period_id{also}"
    return f"""{_probs(base, keys)},
anom as (select {keys}, avg(acc_mm - clim_mean) ens_mean_anomaly from f join lim using (model, cell_id, period_id) group by all),
light as (select {keys}, cast(ens_mean_anomaly as float) ens_mean_anomaly, {', '.join(f'cast({n} as float) {n}' for n in _NAMES)}, cast(clim_mean as float) clim_mean, cast(dry_mask as int) dry_mask from anom join probs using ({keys}) join lim using (model, cell_id, period_id)),
named as (select split_part(cast(period_id as varchar), '-', 1) kind, count(distinct model) models from light group by 1),
multi as (select cell_id, period_id{also}, avg(cast(ens_mean_anomaly as double)) ens_mean_anomaly, {', '.join(f'avg(cast({n} as double)) {n}' for n in _NAMES)}, sum(dry_mask) >= max(models)/2.0e0 dry from light join named on kind = split_part(cast(period_id as varchar), '-', 1) group by all)"""


def _loo(base: str) -> str:
    """Leave-one-out limits, probabilities and `pairs` of the hindcasts `h` and the observations `o`."""
    return f"""{base},
hyear as (select distinct model, cell_id, period_id, year from h),
hl as (select a.model, a.cell_id, a.period_id, a.year, list_sort(list(b.acc_mm)) v from hyear a join h b on a.model = b.model and a.cell_id = b.cell_id and a.period_id = b.period_id and a.year <> b.year group by all),
hloo as (select model, cell_id, period_id, year, {_q('v', '1/3')} lower, {_q('v', '2/3')} upper from hyear left join hl using (model, cell_id, period_id, year)),
ol as (select a.cell_id, a.period_id, a.year, any_value(a.acc_mm) acc_mm, coalesce(list_sort(list(b.acc_mm) filter (b.acc_mm is not null)), []) v from o a left join o b on a.cell_id = b.cell_id and a.period_id = b.period_id and a.year <> b.year group by a.cell_id, a.period_id, a.year),
oloo as (select cell_id, period_id, year, acc_mm, {_q('v', '1/3')} lower, {_q('v', '2/3')} upper from ol),
cat as (select cell_id, period_id, year, case when acc_mm < lower then 0 when acc_mm > upper then 2 else 1 end obs_cat from oloo),
lp as (select model, cell_id, period_id, year, avg(case when acc_mm < lower then 1.0e0 else 0.0e0 end) bn, avg(case when acc_mm > upper then 1.0e0 else 0.0e0 end) an from h join hloo using (model, cell_id, period_id, year) group by all),
pairs as (select model, cell_id, period_id, year, bn p0, 1.0e0 - bn - an p1, an p2, obs_cat from lp join cat using (cell_id, period_id, year))"""


_LIMITS, _PROBS, _LIGHT, _LOO = _limits(_CUBE), _probs(_CUBE, "model, cell_id, period_id"), _light(_CUBE), _loo(f"{_CUBE},{_ORDERS}")


def _scores(source: str, keys: str) -> str:
    e = [f"(case when obs_cat = {i} then 1.0e0 else 0.0e0 end)" for i in range(3)]
    c1, c2 = "(case when obs_cat <= 0 then 1.0e0 else 0.0e0 end)", "(case when obs_cat <= 1 then 1.0e0 else 0.0e0 end)"
    rps = lambda a, b: f"avg((pow({a}-{c1},2)+pow({b}-{c2},2))/2)"
    bss = ", ".join(f'1 - avg(pow(p{i}-{e[i]},2))/avg(pow(1/3-{e[i]},2)) "bss_{k}"' for i, k in enumerate(("BN", "NN", "AN")))
    return f"select {keys}, 1 - {rps('p0', 'p0+p1')}/{rps('1/3', '2/3')} rpss, {bss} from {source} group by all"


def _roc(source: str, keys: str) -> str:
    parts = []
    for i, k in ((0, "BN"), (2, "AN")):
        parts.append(f"""select {keys}, case when sum(e) > 0 and sum(e) < count(*) then sum(case when e = 0 then c else 0.0e0 end)/(sum(e)*(count(*)-sum(e))) end "roc_{k}" from (
 select *, sum(e) over (partition by {keys} order by p{i} desc, year rows unbounded preceding) c from (select *, case when obs_cat = {i} then 1.0e0 else 0.0e0 end e from {source})) group by all""")
    return f"select * from ({parts[0]}) join ({parts[1]}) using ({keys})"


def _skill(base: str) -> str:
    """Correlation and error `skill` of the ensemble means of `h` against `o`."""
    return f"""{base}, ens as (select model, cell_id, period_id, year, avg(acc_mm) e from h group by all),
side as (select {_KEYS}, e, o.acc_mm o, e - avg(e) over w ea, o.acc_mm - avg(o.acc_mm) over w oa from ens join o using (cell_id, period_id, year) window w as (partition by model, cell_id, period_id)),
skill as (select {_KEYS}, sum(ea*oa)/nullif(sqrt(sum(ea*ea)*sum(oa*oa)), 0.0e0) corr_ens, sqrt(avg((e-o)*(e-o))) rmse_ens from side group by all)"""


_SKILL = _skill(_LOO)
_MPAIRS = f"""{_LOO}, mm as (select cell_id, period_id, year, min(obs_cat) obs_cat, avg(p0) a, avg(p1) b, avg(p2) c from pairs group by cell_id, period_id, year having count(*) = (select count(distinct model) from h)),
mp as (select cell_id, period_id, year, obs_cat, round(a/(case when a+b+c = 0 then 1 else a+b+c end), 12) p0, round(b/(case when a+b+c = 0 then 1 else a+b+c end), 12) p1, round(c/(case when a+b+c = 0 then 1 else a+b+c end), 12) p2 from mm)"""

# Spellings of units in the test tables; unlike the operator's grammar, the SQL goes by whole spellings.
_SPELLINGS = {
    "tenth_mm": r"mm/10|0[.,]1 mm|1e-4 m|tenths of (?:a )?mm|tenths of a millimetre|dixièmes de mm",
    "mm_per_s": r"mm/s|mm s-1|kg m\*\*-2 s\*\*-1|kg/\(m2 s\)|kg m-2 s-1|mm par seconde|kg per square metre and second",
    "m_per_s": r"m/s|m s\*\*-1|m s-1|metres per second|m par seconde",
    "cm": r"(?:cm|centimetres?|centimeters?|centimètres)(?: d-1|/day| day-1)?",
    "inch": r"(?:in\.?|inch|inches|pouces)(?: d-1|/day| day-1)?",
    "m": r"(?:m|metres?|meters?|mètres|m of water equivalent|m w\.e\.)(?: d-1|/day| day-1)?",
    "mm": r"(?:mm|millimetres?|millimeters?|kg m-2|kg/m2|kg m\*\*-2|l m-2)(?: d-1|/day| day-1| day\*\*-1)?",
}
_MM = {"m": 1000.0, "cm": 10.0, "mm": 1.0, "inch": 25.4, "tenth_mm": 0.1, "mm_per_s": 86400.0, "m_per_s": 86400000.0}


def _unit_of(text: str, before: str = "^") -> str:
    """The unit whose spelling stands at the end of a text, behind `before`."""
    return "case " + " ".join(f"when regexp_matches(lower(trim({text})), '{before}(?:{p})\\)?$') then '{u}'" for u, p in _SPELLINGS.items()) + " end"


_FACTOR = lambda unit: f"(case {unit} " + " ".join(f"when '{u}' then {v!r}e0" for u, v in _MM.items()) + " end)"
_NOTED = _unit_of("remark", "(?:^|^in |read in |^this one in |^already |noted in |repris en |lecture en |valeur en |compté en |entered in )").replace("case ", "case when remark in ('inches, old pad') then 'inch' when remark in ('cm not mm') then 'cm' when remark in ('in 0.1 mm counts', 'compté en 1/10 mm') then 'tenth_mm' ", 1)
UNITS = f"""stated as (select file_id, field, coalesce(min({_unit_of("units")}), min({_unit_of("note", "(?:archive unit: |values kept in |not rescaled, still |unité d''origine )")}), min({_unit_of("long_name", "(?: en | in |, |[(]unit |[(]| de | as )")})) stated from file_attrs group by all),
noted as (select *, {_NOTED} noted from obs_daily),
sizes as (select file_id, 'tp' field, median(case when tp > 0 and tp < 'infinity' then tp end) size from fcst_daily group by 1 union all select file_id, 'tp_daily', median(case when tp_daily > 0 and tp_daily < 'infinity' then tp_daily end) from fcst_daily group by 1
  union all select file_id, 'precip', median(case when noted is null and precip > 0 and precip < 'infinity' then precip end) from noted group by 1),
known as (select sizes.*, stated from sizes left join stated using (file_id, field)),
usual as (select field, median(log10(size * {_FACTOR('stated')})) usual from known where stated is not null and size is not null group by 1),
units as (select file_id, field, coalesce(stated, case when size is not null then arg_min(u, abs(log10(size * k) - coalesce(usual, log10(case field when 'tp' then 48.0e0 else 2.5e0 end)))) end, case field when 'tp' then 'm' else 'mm' end) unit
  from known left join usual using (field), (values {', '.join(f"('{u}', {v!r}e0)" for u, v in _MM.items())}) x(u, k) group by file_id, field, stated, size),
fcst_mm as (select f.* exclude (tp, tp_daily), tp * {_FACTOR('a.unit')} / 1000.0e0 tp, tp_daily * {_FACTOR('b.unit')} tp_daily from fcst_daily f left join units a on a.file_id = f.file_id and a.field = 'tp' left join units b on b.file_id = f.file_id and b.field = 'tp_daily'),
obs_mm as (select o.* exclude (precip), precip * {_FACTOR('coalesce(o.noted, unit)')} precip, coalesce(o.noted, unit) unit from noted o left join units u on u.file_id = o.file_id and u.field = 'precip')"""

_FC = f"""{UNITS}, fk as (select * from (select *, row_number() over (partition by file_id, model, kind, number, init_time, step_h, valid_time, cell_id order by received desc, fcst_id desc) rn from fcst_mm) where rn = 1),
fd as (select * exclude (tp_daily), case when not isnan(tp_daily) and abs(tp_daily) <= 1900 then tp_daily end tp_daily from fk)"""
_OB_ROWS = """ok as (select o.* from (select *, row_number() over (partition by file_id, time, latitude, longitude order by row_id desc) rn from obs_mm) o where rn = 1),
ob as (select ok.*, g.cell_id from ok join grid g using (latitude, longitude))"""
_OB = f"{UNITS}, {_OB_ROWS}"
_DECUMULATED = """x as (select *, case when not isnan(tp) then tp end * 1000.0e0 v, lag(step_h) over w ps, lag(case when not isnan(tp) then tp end * 1000.0e0) over w pv, row_number() over w k from fk window w as (partition by file_id, number, cell_id order by step_h)),
dd as (select * exclude (tp, tp_daily, v, ps, pv, k, rn), case when t < 0 then 0.0e0 else t end tp_daily from (select *, case when k = 1 then case when step_h = 0 then 0.0e0 else v end when step_h - ps = 24 then v - pv end t from x))"""
_SPANS = "spans as (select file_id, min(cast(valid_time as date)) first, max(cast(valid_time as date)) last from fcst_daily group by 1)"
_MONTHS = "months as (select *, unnest(generate_series(date_trunc('month', first)::timestamp, last::timestamp, interval 1 month))::date m from spans where first <= last)"


def _period(kind: str, body: str) -> str:
    return f"select file_id, '{kind}' as type, label, \"start\", \"end\", cast(month(\"start\")*100+day(\"start\") as int) start_md, cast(month(\"end\")*100+day(\"end\") as int) end_md, cast(\"end\"-\"start\"+1 as int) n_days from ({body}) where \"start\" <= \"end\""


_M = _period("month", "select file_id, strftime(m, '%Y-%m') as label, greatest(m, first) as \"start\", last_day(m) as \"end\" from months where last_day(m) <= last")
_DEC = "select *, strftime(m, '%Y-%m-') || tag as label, greatest(m + (a-1)::int, first)::date as \"start\", (case when b = 0 then last_day(m) else m + (b-1)::int end)::date as \"end\" from months, (values (1,10,'D1'),(11,20,'D2'),(21,0,'D3')) v(a,b,tag)"
_D = _period("decade", f"select * from ({_DEC}) where \"end\" <= last")
_S = _period("season", "select *, strftime(\"start\", '%Y-%m-%d') || '_to_' || strftime(\"end\", '%Y-%m-%d') as label from (select *, greatest(m, first) as \"start\", last_day(m) as \"end\" from months) where \"end\" <= last")
_C = _period("custom", "select *, strftime(first, '%Y-%m-%d') || '_to_' || strftime(last, '%Y-%m-%d') as label, first as \"start\", last as \"end\" from spans")
_SPAN = "'(' || strftime(\"start\", '%d %b') || ' - ' || strftime(\"end\", '%d %b %Y') || ')'"
_FULL = "strftime(\"start\", '%d %b %Y') || ' - ' || strftime(\"end\", '%d %b %Y')"
_AREA = ",".join(str(x) for x in cds_area(config.AREA))


def _season(day: str, keys: str, value: str, source: str, seasons: list[tuple[str, int, int]]) -> str:
    rows = ", ".join(f"('{n}', {a}, {b})" for n, a, b in seasons)
    md = f"(month({day})*100+day({day}))"
    hit = f"case when a <= b then {md} between a and b else {md} >= a or {md} <= b end"
    return f"select {keys}, season, round(coalesce(sum(case when {hit} then {value} end), 0.0e0) + 1e-9, 6) acc_mm from {source}, (values {rows}) s(season, a, b) group by all"


def _round(names: list[str], n: int = 6) -> str:
    return ", ".join(f"round({x}, {n}) {x}" for x in names)


def _levels(x: str, levels: tuple[float, ...]) -> str:
    return f"case when {x} is not null then " + " + ".join(f"(case when {x} >= {v} then 1 else 0 end)" for v in levels) + " end"


_CLASS = "case when {dry} then 'D' when {a} > 0.38e0 and ({b} < 0.33e0 or {n} > 0.33e0) then 'A' when {b} > 0.38e0 and ({a} < 0.33e0 or {n} > 0.33e0) then 'B' when {n} > 0.38e0 and {a} < 0.33e0 and {b} < 0.33e0 then 'N' else 'W' end"

ORACLE: dict[str, str] = {
    "decumulate": f"""with {_FC}, x as (select fcst_id, step_h, case when not isnan(tp) then tp end * 1000.0e0 v, lag(step_h) over w ps, lag(case when not isnan(tp) then tp end * 1000.0e0) over w pv, row_number() over w k from fk window w as (partition by file_id, number, cell_id order by step_h)),
d as (select fcst_id, case when k = 1 then case when step_h = 0 then 0.0e0 else v end when step_h - ps = 24 then v - pv end t from x) select fcst_id, round(case when t < 0 then 0.0e0 else t end + 1e-9, 6) tp_daily from d""",
    "periods_month": f"with {_SPANS}, {_MONTHS} {_M}",
    "periods_decade": f"with {_SPANS}, {_MONTHS} {_D}",
    "periods_season": f"with {_SPANS}, {_MONTHS} {_S}",
    "periods_partial": "with "
    + _SPANS.replace("max(cast(valid_time as date))", "least(max(cast(valid_time as date)), date '2023-06-15')")
    + f", {_MONTHS} "
    + _period("decade", f"select * exclude (\"end\"), least(\"end\", last) as \"end\" from ({_DEC})"),
    "period_custom": f"with {_SPANS} {_C}",
    "accumulate_forecast": f"""with {_FC}, {_SPANS}, {_MONTHS}, per as ({_D}), fo as (select * from fd where kind = 'forecast'), fr as (select distinct file_id, number, cell_id from fo)
select fr.file_id, fr.number, fr.cell_id, per.label, round(coalesce(sum(fo.tp_daily), 0.0e0) + 1e-9, 6) acc_mm from fr join per on fr.file_id = per.file_id left join fo on fo.file_id = fr.file_id and fo.number = fr.number and fo.cell_id = fr.cell_id and cast(fo.valid_time as date) between per."start" and per."end" group by all""",
    "accumulate_hindcast": f"with {_FC} " + _season("valid_time", "model, number, cast(year(init_time) as int) init_year, cell_id", "tp_daily", "(select * from fd where kind = 'hindcast')", [("MAM", 301, 531), ("JJA", 601, 831), ("SON", 901, 1130)]),
    "monthday_wraparound": f"with {_OB} " + _season("time", "cell_id, cast(year(time) as int) as year", "case when not isnan(precip) and abs(precip) <= 1900 then precip end", "ob", [("DJF", 1201, 228), ("NDJF", 1101, 229)]),
    "obs_accumulate": f"with {_OB} select file_id, cell_id, cast(year(time) as int) as year, cast(month(time) as int) as month, round(case when count(*) = count(case when not isnan(precip) then 1 end) then sum(precip) end + 1e-9, 6) acc_mm from ob group by all",
    "ens_mean_daily": f"with {_FC} select file_id, cell_id, step_h, round(avg(tp_daily) + 1e-9, 6) ens_mean from fd group by all",
    "dispersion": f"with {_FC} select fcst_id, round(tp_daily - avg(tp_daily) over (partition by file_id, cell_id, step_h) + 1e-9, 6) deviation from fd",
    "exceedance_daily": f"with {_FC} select file_id, cell_id, step_h, threshold_mm, round(sum(case when tp_daily >= threshold_mm then 1 else 0 end)/cast(count(*) as double), 6) prob from fd, (values (1),(5),(10),(20)) t(threshold_mm) group by all",
    "climatology_anomaly": f"with {_LIMITS} select {_KEYS}, number, round(clim_mean, 6) clim_mean, round(acc_mm - clim_mean, 6) anomaly from f join lim using (model, cell_id, period_id)",
    "quantile_thresholds": f"with {_LIMITS} select {_KEYS}, round(lo3,6) tercile_lower, round(up3,6) tercile_upper, round(lo5,6) quintile_lower, round(up5,6) quintile_upper, round(med,6) median, round(clim_mean,6) clim_mean, dry_mask from lim",
    "tercile_probs": f"with {_PROBS} select {_KEYS}, {_round(_NAMES)} from probs",
    "coherence": f"with {_PROBS} select model, round(max(abs(\"prob_BN\"+\"prob_NN\"+\"prob_AN\"-1)), 6) worst from probs group by 1",
    "exceedance": f"with {_CUBE} select {_KEYS}, threshold_mm, round(sum(case when acc_mm >= threshold_mm then 1 else 0 end)/cast(count(*) as double), 6) prob from f, (values {', '.join(f'({t})' for t in config.EXCEEDANCE_MM)}) t(threshold_mm) group by all",
    "light_products": f"with {_LIGHT} select {_KEYS}, {', '.join(f'round(cast({x} as double), 4) {x}' for x in ['ens_mean_anomaly', *_NAMES, 'clim_mean'])}, dry_mask from light",
    "multimodel_mean": f"with {_LIGHT} select cell_id, period_id, {_round(['ens_mean_anomaly', *_NAMES], 4)} from multi",
    "multimodel_tercile": f"with {_LIGHT}, n as (select *, case when \"prob_BN\"+\"prob_NN\"+\"prob_AN\" = 0 then 1 else \"prob_BN\"+\"prob_NN\"+\"prob_AN\" end s from multi) select cell_id, period_id, "
    + ", ".join(f'round("prob_{k}"/s, 4) "norm_{k}"' for k in ("BN", "NN", "AN"))
    + " from n",
    "multimodel_dry_vote": f"with {_LIGHT} select cell_id, period_id, dry from multi",
    "tercile_summary_class": f"""with {_PROBS} select {_KEYS}, case when dry_mask then 'D' when "prob_AN" > 0.38e0 and ("prob_BN" < 0.33e0 or "prob_NN" > 0.33e0) then 'A' when "prob_BN" > 0.38e0 and ("prob_AN" < 0.33e0 or "prob_NN" > 0.33e0) then 'B'
 when "prob_NN" > 0.38e0 and "prob_AN" < 0.33e0 and "prob_BN" < 0.33e0 then 'N' else 'W' end as class from probs join lim using (model, cell_id, period_id)""",
    "loo_terciles_model": f"with {_LOO} select {_KEYS}, year, round(lower,6) lower, round(upper,6) upper from hloo",
    "loo_terciles_obs": f"with {_LOO} select cell_id, period_id, year, round(lower,6) lower, round(upper,6) upper from oloo",
    "loo_probs": f'with {_LOO} select {_KEYS}, year, round(bn,6) "pBN", round(1.0e0-bn-an,6) "pNN", round(an,6) "pAN" from lp',
    "obs_category": f"with {_LOO} select cell_id, period_id, year, obs_cat from cat",
    "rpss": f"with {_LOO}, s as ({_scores('pairs', _KEYS)}) select {_KEYS}, round(rpss,6) rpss from s",
    "bss": f"with {_LOO}, s as ({_scores('pairs', _KEYS)}) select {_KEYS}, " + ", ".join(f'round("bss_{k}",6) "bss_{k}"' for k in ("BN", "NN", "AN")) + " from s",
    "roc_area": f'with {_LOO}, s as ({_roc("pairs", _KEYS)}) select {_KEYS}, round("roc_BN",6) "roc_BN", round("roc_AN",6) "roc_AN" from s',
    "ens_skill": f"with {_SKILL} select {_KEYS}, round(corr_ens,6) corr_ens, round(rmse_ens,6) rmse_ens from skill",
    "reliability": f"""with {_LOO}, z as (select pairs.* from pairs join cz using (cell_id) where in_zone),
l as (select model, period_id, 'BN' category, p0 p, case when obs_cat=0 then 1.0e0 else 0.0e0 end e from z union all select model, period_id, 'NN', p1, case when obs_cat=1 then 1.0e0 else 0.0e0 end from z union all select model, period_id, 'AN', p2, case when obs_cat=2 then 1.0e0 else 0.0e0 end from z),
b as (select cast(i as int) bin, i*0.1e0 lo, (i+1)*0.1e0 hi from range(0,10) r(i)), k as (select distinct model, period_id, category from l)
select k.model, k.period_id, k.category, b.bin, count(l.p) n, round(avg(l.p),6) mean_fcst, round(avg(l.e),6) obs_freq from k cross join b left join l on l.model = k.model and l.period_id = k.period_id and l.category = k.category and l.p >= b.lo and (l.p < b.hi or (b.bin = 9 and l.p <= 1.0e0)) group by all""",
    "domain_stats": f"with {_LOO}, s as ({_scores('pairs', _KEYS)}) select model, period_id, round(avg(rpss),6) mean, round(avg(case when round(rpss,9) > 0 then 1.0e0 when rpss is not null then 0.0e0 end),6) positive from s join cz using (cell_id) where in_zone group by all",
    "multimodel_verification": f"with {_MPAIRS}, s as ({_scores('mp', 'cell_id, period_id')}), r as ({_roc('mp', 'cell_id, period_id')}) select cell_id, period_id, "
    + ", ".join(f'round("{c}",6) "{c}"' for c in ("rpss", "bss_BN", "bss_NN", "bss_AN", "roc_BN", "roc_AN"))
    + " from s join r using (cell_id, period_id)",
    "polygon_mask": """with i as (select distinct cell_id from (select cell_id, adm0_a3, poly_id from grid g join zone_edges e on (e.y1 > g.latitude) <> (e.y2 > g.latitude) and g.longitude < (e.x2-e.x1)*(g.latitude-e.y1)/(e.y2-e.y1)+e.x1 group by all having count(*) % 2 = 1))
select grid.cell_id, i.cell_id is not null in_zone from grid left join i on grid.cell_id = i.cell_id""",
    "mask_census": f"""with {_OB}, i as (select distinct cell_id from (select cell_id, adm0_a3, poly_id from grid g join zone_edges e on (e.y1 > g.latitude) <> (e.y2 > g.latitude) and g.longitude < (e.x2-e.x1)*(g.latitude-e.y1)/(e.y2-e.y1)+e.x1 group by all having count(*) % 2 = 1))
select file_id, count(i.cell_id) inside, count(*) total from ob left join i on ob.cell_id = i.cell_id group by 1""",
    "bilinear_regrid": f"""with {_OB}, mean as (select cell_id, avg(case when not isnan(precip) and abs(precip) <= 1900 then precip end) m from ob group by 1), src as (select latitude, longitude, m v from grid left join mean using (cell_id)),
t as (select station, min(longitude) x, min(latitude) y from stations group by 1), ax as (select longitude x0, lead(longitude) over (order by longitude) x1 from (select distinct longitude from grid)), ay as (select latitude y0, lead(latitude) over (order by latitude) y1 from (select distinct latitude from grid)),
w as (select station, x0, x1, y0, y1, (x-x0)/(x1-x0) wx, (y-y0)/(y1-y0) wy from t join ax on x >= x0 and (x < x1 or (x = x1 and x1 = (select max(longitude) from grid))) join ay on y >= y0 and (y < y1 or (y = y1 and y1 = (select max(latitude) from grid)))),
c as (select station, x0 longitude, y0 latitude, (1-wx)*(1-wy) k from w union all select station, x1, y0, wx*(1-wy) from w union all select station, x0, y1, (1-wx)*wy from w union all select station, x1, y1, wx*wy from w),
r as (select station, case when count(v) = 4 then sum(k*v) end p from c left join src using (latitude, longitude) group by 1) select t.station, round(p + 1e-9, 6) precip from t left join r using (station)""",
    "station_detect": "select file_name, case when max(case when line_no = 1 then upper(regexp_extract(raw, '^\\W*(\\w+)', 1)) end) = 'ID' then 'cdt' end fmt from station_lines group by 1",
    "station_nudge": "select station, round(longitude + 1e-6*(row_number() over (partition by cadence_h, longitude order by station)-1), 7) longitude, round(latitude + 1e-6*(row_number() over (partition by cadence_h, latitude order by station)-1), 7) latitude from stations",
    "station_cdt": """with head as (select file_name, regexp_extract(regexp_replace(arg_min(raw, line_id), '^\\x{FEFF}', ''), '^\\s*(?:"[^"]*"|[^",;\t]*?)\\s*([,;\t])', 1) d from station_lines where line_no = 1 group by 1),
line as (select l.file_name, line_no, coalesce(nullif(d, ''), ',') d, regexp_replace(regexp_replace(regexp_replace(raw, '^\\x{FEFF}+', ''), '[\\r\\n]+$', ''), '\\x{A0}', ' ', 'g') t from station_lines l left join head using (file_name)),
form as (select *, case when d = chr(9) then '[ ]*' else '[ \\t]*' end b from line where regexp_matches(t, '[^ \\t]')),
well as (select file_name, line_no, list_transform(regexp_extract_all(t, '(?:^|' || d || ')(' || b || '"(?:[^"]|"")*"' || b || '|[^"' || d || ']*)', 1), lambda x: regexp_replace(x, '^[ \\t]+|[ \\t]+$', '', 'g')) f from form
  where regexp_full_match(t, '(?:' || b || '"(?:[^"]|"")*"' || b || '|[^"' || d || ']*)(?:' || d || '(?:' || b || '"(?:[^"]|"")*"' || b || '|[^"' || d || ']*))*')),
cell as (select file_name, line_no, p pos, upper(f[1]) label, f[1] as key, case when x[1] = '"' then trim(replace(x[2:-2], '""', '"')) else x end v from (select *, unnest(range(2, len(f) + 1)) p, unnest(f[2:]) x from well)),
h as (select file_name, pos, max(case when line_no = 1 then v end) station, try_cast(max(case when line_no in (2, 3) and label like 'LON%' then v end) as double) x, try_cast(max(case when line_no in (2, 3) and label like 'LAT%' then v end) as double) y,
  try_cast(max(case when line_no = 4 and regexp_matches(label, 'ELEV|DAILY|DEKAD|MONTH') then v end) as double) elevation from cell group by all),
n as (select file_name, pos, station, x + 1e-6*(row_number() over (partition by file_name, x order by pos) - 1) longitude, y + 1e-6*(row_number() over (partition by file_name, y order by pos) - 1) latitude, elevation from h where station is not null),
v as (select file_name, pos, cast(try_strptime(key, '%Y%m%d') as date) as time, try_cast(v as double) p from cell where line_no > 1 and regexp_full_match(key, '[0-9]{8}'))
select file_name, station, round(longitude, 7) longitude, round(latitude, 7) latitude, elevation, time, case when not isnan(p) and not (abs(p+999) <= 1e-8+1e-5*999 or abs(p+99) <= 1e-8+1e-5*99 or abs(p+9999) <= 1e-8+1e-5*9999) then p end prcp from v join n using (file_name, pos) where time is not null""",
    "summary_text": f"with {_SKILL}, s as ({_scores('pairs', _KEYS)}), r as ({_roc('pairs', _KEYS)}), t as (select model || ' ' || period_id as label, avg(rpss) + 1e-9 a, avg(case when round(rpss, 9) > 0 then 1.0e0 else 0.0e0 end) + 1e-9 p, avg(\"roc_BN\") + 1e-9 bn, avg(\"roc_AN\") + 1e-9 an, avg(corr_ens) + 1e-9 c from s join r using ({_KEYS}) join skill using ({_KEYS}) join cz using (cell_id) where in_zone group by all) select label, printf('%-40s  %8.3f  %7.1f%%  %9.3f  %9.3f  %8.3f', label, a, p*100, bn, an, c) as line from t",
    "station_missing": "select station, count(*) n, count(case when not isnan(prcp) and not (abs(prcp+999) <= 1e-8+1e-5*999 or abs(prcp+99) <= 1e-8+1e-5*99 or abs(prcp+9999) <= 1e-8+1e-5*9999) then 1 end) known from station_obs group by 1",
    "decode_months_since": "select row_id, cast(case when (day(time)-1)/32.0e0 > 0.5 or ((day(time)-1)/32.0e0 = 0.5 and ((year(time)-1960)*12+month(time)-1) % 2 = 1) then date_trunc('month', time) + interval 1 month else date_trunc('month', time) end as date) as month from obs_daily",
    "nmme_valid_time": "select fcst_id, cast(date_trunc('month', init_time) + to_months(cast(floor(step_h/720) as int)) as date) valid_month from fcst_daily",
    "nmme_url": f"""select distinct model, init_time, kind, replace('{config.IRIDL}{config.NMME_SOURCE}/.' || model || '/.' || upper(kind) || '/.MONTHLY/.prec{box(config.AREA)}/S/(0000 ' || day(init_time) || strftime(init_time, ' %b %Y') || ')/VALUES/data.nc', ' ', '%20') url from fcst_daily""",
    "chirps_url": f"select file_id, '{config.IRIDL}{config.CHIRPS_SOURCE}{box(config.AREA)}/T/(Jan%20' || min(year(time)) || ')/(Dec%20' || max(year(time)) || ')/RANGEEDGES/data.nc' url from obs_daily group by 1",
    "tamsat_url": f"select file_id, '{config.IRIDL}{config.TAMSAT_SOURCE}{box(config.AREA)}/T/(Jan%20' || min(year(time)) || ')/(Dec%20' || max(year(time)) || ')/RANGEEDGES/data.nc' url from obs_daily group by 1",
    "area_subset": "select site_id, longitude, latitude from sites where longitude between 4 and 36 and latitude between -21 and 25",
    "c3s_request": f"select model originating_centre, case model "
    + " ".join(f"when '{k}' then '{v}'" for k, v in config.C3S_SYSTEMS.items())
    + f" end as system, '01' as day, kind, lpad(cast(month(init_time) as varchar), 2, '0') as month, string_agg(distinct cast(year(init_time) as varchar), ',' order by cast(year(init_time) as varchar)) as years, array_to_string(list_transform(list_sort(list(distinct step_h)), lambda x: cast(x as varchar)), ',') leadtime_hour, 'total_precipitation' as variable, 'grib' data_format, '{_AREA}' area from fcst_daily group by all",
    "era5_request": f"select cast(year(time) as varchar) as year, string_agg(distinct lpad(cast(month(time) as varchar), 2, '0'), ',' order by lpad(cast(month(time) as varchar), 2, '0')) as months, 'total_precipitation' as variable, '{_AREA}' area from obs_daily group by 1",
    "period_label": f"""with {_SPANS}, {_MONTHS}, p as ({_M} union all {_D} union all {_S} union all {_C}) select file_id, type, "start", "end",
case type when 'decade' then 'Décade ' || case when day("start") <= 10 then '1' when day("start") <= 20 then '2' else '3' end || ' - ' || strftime("start", '%B %Y') || chr(10) || {_SPAN} when 'month' then strftime("start", '%B %Y') || chr(10) || {_SPAN}
 when 'season' then 'Saison ' || strftime("start", '%b') || '-' || strftime("end", '%b %Y') || chr(10) || {_SPAN} else 'Période personnalisée' || chr(10) || '(' || {_FULL} || ')' end title from p""",
    "model_titles": "select model, case model "
    + " ".join(f"when '{k}' then '{v}'" for k, v in config.MODEL_NAMES.items())
    + " else model end title, count(*) n, cast(max(number) - min(number) + 1 as int) members from fcst_daily group by model",
    "output_names": f"with {_SPANS}, {_MONTHS}, p as ({_M} union all {_D} union all {_S} union all {_C}) select file_id, type, label, case type when 'custom' then type else type || 's' end subfolder, type || '-' || replace(label, '/', '-') || '_x' as name from p",
    "contour_level_bin": f"with {_LIMITS}, a as (select {_KEYS}, round(avg(acc_mm - clim_mean), 6) m from f join lim using (model, cell_id, period_id) group by all) select {_KEYS}, {_levels('m', config.LEVELS['month'])} as level from a",
    "map_layers_probability": f"with {_PROBS}, l as ("
    + " union all ".join(f"select {_KEYS}, {n.replace(chr(34), chr(39)) if n[0] == chr(34) else chr(39) + n + chr(39)} layer, {n} p from probs" for n in _NAMES)
    + f"), q as (select {_KEYS}, layer, case when in_zone and not dry_mask then round(p*100, 6) end percent from l join lim using (model, cell_id, period_id) left join cz using (cell_id)) select *, case when percent is not null then cast(floor(least(percent, 99.0e0)/10) as double) end bin from q",
    "map_layers_exceedance": f"with {_CUBE}, e as (select {_KEYS}, threshold_mm, sum(case when acc_mm >= threshold_mm then 1 else 0 end)/cast(count(*) as double) prob from f, (values {', '.join(f'({t})' for t in config.EXCEEDANCE_MM)}) t(threshold_mm) group by all) select {_KEYS}, threshold_mm, case when in_zone then round(prob*100, 6) end percent from e left join cz using (cell_id)",
    "map_layers_skill": f"with {_LOO}, s as ({_scores('pairs', _KEYS)}), k as (select {_KEYS}, round(rpss, 6) r from s) select {_KEYS}, {_levels('r', config.SKILL_LEVELS)} as level from k",
    "map_layers_anomaly": f"with {_LIMITS}, a as (select {_KEYS}, number, case when in_zone then round(acc_mm - clim_mean, 6) end anomaly from f join lim using (model, cell_id, period_id) left join cz using (cell_id)) select *, cast({_levels('anomaly', config.LEVELS['month'])} as double) as level from a",
    "map_layers_mean": f"with {_LIGHT}, a as (select {_KEYS}, case when in_zone then round(cast(ens_mean_anomaly as double), 4) end mean from light left join cz using (cell_id)) select *, cast({_levels('mean', config.LEVELS['month'])} as double) as level from a",
    "map_layers_dispersion": f"with {_CUBE}, x as (select {_KEYS}, number, acc_mm - avg(acc_mm) over (partition by model, cell_id, period_id) dev from f), y as (select *, greatest(1.0e0, 0.8e0 * max(abs(dev)) over (partition by model, period_id)) lim from x) select {_KEYS}, number, case when in_zone then round(dev, 6) end deviation, round(lim, 6) colour_limit from y left join cz using (cell_id)",
    "map_layers_terciles": f"with {_PROBS} select {_KEYS}, case when in_zone then {_CLASS.format(dry='dry_mask', b='\"prob_BN\"', n='\"prob_NN\"', a='\"prob_AN\"')} end as class from probs join lim using (model, cell_id, period_id) left join cz using (cell_id)",
    "multimodel_tercile_panel": f"""with {_LIGHT}, p as (select model, cell_id, period_id, "prob_BN" b, "prob_NN" n, "prob_AN" a, 1 s, dry_mask = 1 dry from light union all select 'multi_model', cell_id, period_id, "prob_BN", "prob_NN", "prob_AN", case when "prob_BN"+"prob_NN"+"prob_AN" = 0 then 1 else "prob_BN"+"prob_NN"+"prob_AN" end, dry from multi),
q as (select model, cell_id, period_id, round(cast(b as double)/s, 6) b, round(cast(n as double)/s, 6) n, round(cast(a as double)/s, 6) a, dry from p) select model, cell_id, period_id, {_CLASS.format(dry='dry', b='b', n='n', a='a')} as class from q""",
    "reliability_diagram": f"""with {_LOO}, z as (select pairs.* from pairs join cz using (cell_id) where in_zone),
l as (select period_id, 'BN' category, p0 p, case when obs_cat=0 then 1.0e0 else 0.0e0 end e from z union all select period_id, 'NN', p1, case when obs_cat=1 then 1.0e0 else 0.0e0 end from z union all select period_id, 'AN', p2, case when obs_cat=2 then 1.0e0 else 0.0e0 end from z),
b as (select cast(i as int) bin, i*0.1e0 lo, (i+1)*0.1e0 hi from range(0,10) r(i)), s as (select period_id, category, bin, count(*) n, avg(p) mean_fcst, avg(e) obs_freq from l join b on p >= lo and (p < hi or (bin = 9 and p <= 1.0e0)) group by all)
select period_id, category, bin, n, round(mean_fcst, 6) mean_fcst, round(obs_freq, 6) obs_freq, round(n/sum(n) over (partition by period_id, category), 6) share from s""",
    "station_cpt": """with y as (select station, year(time) yr, round(sum(case when not isnan(prcp) and prcp between 0 and 1900 then prcp end) + 1e-9, 2) prcp from station_obs where station is not null and time is not null group by all),
s as (select station, min(longitude) longitude, min(latitude) latitude from stations where station is not null group by 1) select station, longitude, latitude, make_date(yr, 8, 1) as time, prcp from y join s using (station)""",
    "multimodel_panel": f"with {_LIGHT} select model, cell_id, period_id, round(cast(ens_mean_anomaly as double), 4) ens_mean_anomaly from light union all select 'multi_model', cell_id, period_id, round(ens_mean_anomaly, 4) from multi",
}
ORACLE["model_contract"] = ORACLE["tercile_probs"]
