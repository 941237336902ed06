"""DuckDB stages of the closed-form forecasts, in long form (one row per step)."""

from __future__ import annotations

from checks.sql import rnd, stage

KEY = "company_id, target, fold"
EDGE = "0.999::double"

stage(
    "series",
    """  select company_id, target, last_date, n, row_number() over (partition by company_id, target order by date) - 1 as t, y, date
  from (select company_id, date, 'revenue' as target, revenue as y from records
    union all select company_id, date, 'profit', profit from records)
  join (select company_id, max(date) as last_date, count(*) as n from records group by company_id) using (company_id)
  where n >= 8""",
    "records",
)
stage(
    "folds",
    """  select company_id, target, 'full' as fold, n, t, y from series
  union all select company_id, target, 'held_out', n - 4, t, y from series where n >= 12 and t < n - 4""",
    "series",
)
stage("heads", f"  select distinct {KEY}, n from folds", "folds")
stage("steps", "  select unnest([1, 2, 3, 4]) as step")


def _clamped(x: str) -> str:
    return f"greatest(least({x}, {EDGE}), -{EDGE})"


# ARIMA(1,1,1): the same three grids of theta, each with its best phi.
stage(
    "changes",
    f"""  select * from (select {KEY}, n, t - 1 as i, y - lag(y) over (partition by {KEY} order by t) as d from folds)
  where i >= 0""",
    "folds",
)


def _search(name: str, grid: str, needs: tuple[str, ...]) -> None:
    stage(f"{name}_grid", grid, *needs)
    stage(
        f"{name}_path",
        f"""  select {KEY}, n, theta, i, d as a, d * d as aa, 0::double as ab
  from {name}_grid join changes using ({KEY}) where i = 0
  union all
  select p.company_id, p.target, p.fold, p.n, p.theta, c.i, c.d - p.theta * p.a,
    p.aa + (c.d - p.theta * p.a) * (c.d - p.theta * p.a), p.ab + (c.d - p.theta * p.a) * p.a
  from {name}_path p join changes c
    on c.company_id = p.company_id and c.target = p.target and c.fold = p.fold and c.i = p.i + 1""",
        "changes",
        f"{name}_grid",
    )
    stage(
        name,
        f"""  select {KEY}, arg_min(theta, (ssr, theta)) as theta, arg_min(phi, (ssr, theta)) as phi
  from (select *, aa - 2 * phi * ab + phi * phi * lagged as ssr
    from (select *, {_clamped('coalesce(ab / nullif(lagged, 0), 0)')} as phi
      from (select *, aa - a * a as lagged from {name}_path where i = n - 2)))
  group by {KEY}""",
        f"{name}_path",
    )


_search(
    "coarse",
    f"  select {KEY}, k * 0.05::double as theta from heads, (select unnest(range(-19, 20)) as k)",
    ("heads",),
)
_search(
    "fine",
    f"  select {KEY}, {_clamped('theta + k * 0.005::double')} as theta from coarse, (select unnest(range(-10, 11)) as k)",
    ("coarse",),
)
_search(
    "fit",
    f"  select {KEY}, {_clamped('theta + k * 0.0005::double')} as theta from fine, (select unnest(range(-10, 11)) as k)",
    ("fine",),
)
stage(
    "arima_path",
    f"""  select {KEY}, c.n, phi, theta, i, d, d as e, y + d as actual, y + (d - d) as level
  from fit join changes c using ({KEY}) join folds f using ({KEY}) where i = 0 and f.t = 0
  union all
  select p.company_id, p.target, p.fold, p.n, p.phi, p.theta, c.i, c.d, c.d - p.phi * p.d - p.theta * p.e,
    p.actual + c.d, p.level + (c.d - (c.d - p.phi * p.d - p.theta * p.e))
  from arima_path p join changes c
    on c.company_id = p.company_id and c.target = p.target and c.fold = p.fold and c.i = p.i + 1""",
    "fit",
    "changes",
    "folds",
)
stage("arima_pairs", f"  select {KEY}, i + 1 as t, actual as y, level as fitted from arima_path", "arima_path")
stage(
    "arima_sigma",
    f"""  select {KEY}, sqrt(greatest(sum(e * e) / count(*) - (sum(e) / count(*)) * (sum(e) / count(*)), 0)) as sigma
  from arima_path group by {KEY}""",
    "arima_path",
)
stage(
    "arima_forecast",
    f"""  select {KEY}, step, y + s1 * case step when 1 then 1 when 2 then 1 + phi when 3 then 1 + phi + phi * phi
      else 1 + phi + phi * phi + phi * phi * phi end as f
  from (select {KEY}, phi, phi * d + theta * e as s1, y from arima_path p join folds using ({KEY})
    where p.i = p.n - 2 and folds.t = folds.n - 1), steps""",
    "arima_path",
    "folds",
    "steps",
)

# Least squares on the centred index.
stage(
    "moments",
    f"""  select {KEY}, any_value(n) as n, sum(y) as y, sum(u * y) as uy, sum(u * u) as u2, sum(u * u * y) as u2y, sum(u * u * u * u) as u4
  from (select *, t - (n - 1) / 2.0::double as u from folds) group by {KEY}""",
    "folds",
)
_U = "({t} - (n - 1) / 2.0::double)"


def _trend(t: str) -> str:
    return f"(m.y / m.n + m.uy / m.u2 * ({t} - (m.n - 1) / 2.0::double))"


def _curve(t: str) -> str:
    u = f"({t} - (m.n - 1) / 2.0::double)"
    c = "((m.n * m.u2y - m.u2 * m.y) / (m.n * m.u4 - m.u2 * m.u2))"
    return f"((m.y - {c} * m.u2) / m.n + m.uy / m.u2 * {u} + {c} * {u} * {u})"


stage("polynomial_pairs", f"  select {KEY}, f.t, f.y, {_curve('f.t')} as fitted from folds f join moments m using ({KEY})", "folds", "moments")
stage("polynomial_forecast", f"  select {KEY}, step, {_curve('m.n + step - 1')} as f from moments m, steps", "moments", "steps")
stage(
    "factors",
    f"""  select {KEY}, t % 4 as q, avg(f.y / nullif({_trend('f.t')}, 0)) as factor
  from folds f join moments m using ({KEY}) group by {KEY}, t % 4""",
    "folds",
    "moments",
)
stage(
    "seasonal_pairs",
    f"""  select {KEY}, f.t, f.y, {_trend('f.t')} * coalesce(factor, 1) as fitted
  from folds f join moments m using ({KEY}) join factors using ({KEY}) where q = f.t % 4""",
    "folds",
    "moments",
    "factors",
)
stage(
    "seasonal_forecast",
    f"""  select {KEY}, step, {_trend('m.n + step - 1')} * coalesce(factor, 1) as f
  from moments m join factors using ({KEY}), steps where q = (m.n + step - 1) % 4""",
    "moments",
    "factors",
    "steps",
)

# Holt: alpha 0.3, beta 0.1, started from the first two rows.
stage(
    "holt_path",
    f"""  select {KEY}, a.n, 0::bigint as t, a.y as y, a.y as fitted, a.y as level, b.y - a.y as trend
  from folds a join folds b using ({KEY}) where a.t = 0 and b.t = 1
  union all
  select p.company_id, p.target, p.fold, p.n, f.t, f.y, p.level + p.trend,
    0.3::double * f.y + 0.7::double * (p.level + p.trend),
    0.1::double * (0.3::double * f.y + 0.7::double * (p.level + p.trend) - p.level) + 0.9::double * p.trend
  from holt_path p join folds f
    on f.company_id = p.company_id and f.target = p.target and f.fold = p.fold and f.t = p.t + 1""",
    "folds",
)
stage("holt_pairs", f"  select {KEY}, t, y, fitted from holt_path where t > 0", "holt_path")
stage("holt_forecast", f"  select {KEY}, step, level + step * trend as f from holt_path, steps where t = n - 1", "holt_path", "steps")

LABELS = {
    "arima": "ARIMA(1,1,1)",
    "seasonal": "SeasonalTrend(4)",
    "polynomial": "Polynomial(degree=2)",
    "holt": "Holt(alpha=0.3,beta=0.1)",
}

for _position, (_model, _label) in enumerate(LABELS.items()):
    if _model != "arima":
        stage(
            f"{_model}_sigma",
            f"""  select {KEY}, sqrt(greatest(avg((y - fitted) * (y - fitted)) - avg(y - fitted) * avg(y - fitted), 0)) as sigma
  from {_model}_pairs group by {KEY}""",
            f"{_model}_pairs",
        )
    stage(
        f"{_model}_model",
        f"""  select {KEY}, {_position} as position, '{_model}' as model, '{_label}' as label, step, f as forecast,
    f - 1.96::double * sigma * sqrt(step) as lower, f + 1.96::double * sigma * sqrt(step) as upper, mae, rmse, mape
  from {_model}_forecast join {_model}_sigma using ({KEY}) join (
    select {KEY}, {rnd('avg(abs(y - fitted))', 2)} as mae, {rnd('sqrt(avg((y - fitted) * (y - fitted)))', 2)} as rmse,
      {rnd('avg(abs((y - fitted) / nullif(y, 0))) * 100', 2)} as mape
    from {_model}_pairs group by {KEY}) using ({KEY})""",
        f"{_model}_forecast",
        f"{_model}_sigma",
        f"{_model}_pairs",
    )

stage("models", " union all ".join(f"select * from {m}_model" for m in LABELS), *[f"{m}_model" for m in LABELS])
stage(
    "held_errors",
    """  select company_id, target, model, any_value(position) as position, avg(abs((y - forecast) / nullif(y, 0))) * 100 as wf_mape
  from models m join series s using (company_id, target) where fold = 'held_out' and s.t = s.n - 4 + step - 1
  group by company_id, target, model""",
    "models",
    "series",
)
stage(
    "weights",
    """  select company_id, target, model, position, (1 / mape) / sum(1 / mape) over (partition by company_id, target) as w, mape
  from models where fold = 'full' and step = 1 and mape > 0""",
    "models",
)
stage(
    "ensembles",
    f"""  select company_id, target, step, sum(w * forecast) as forecast, sum(w * lower) as lower, sum(w * upper) as upper,
    list_reduce(list(m.mape order by m.position), lambda a, b: a + b) / count(*) as mape, 'Ensemble(' || string_agg(m.model || ':' || cast(cast({rnd('w', 2)} as decimal(4,2)) as varchar), ' | ' order by m.position) || ')' as label
  from models m join weights using (company_id, target, model) where fold = 'full' group by company_id, target, step""",
    "models",
    "weights",
)
stage(
    "singles",
    """  select company_id, target, arg_min(model, (coalesce(wf_mape, 9999), position)) as model, arg_min(wf_mape, (coalesce(wf_mape, 9999), position)) as wf_mape
  from (select distinct company_id, target, model, position from models where fold = 'full')
  left join (select company_id, target, model, wf_mape from held_errors) using (company_id, target, model)
  group by company_id, target""",
    "models",
    "held_errors",
)
stage(
    "winners",
    """  select company_id, target, step, s.wf_mape,
    case when won then 'ensemble' else s.model end as model_name, case when won then e.label else m.label end as label,
    case when won then e.forecast else m.forecast end as forecast, case when won then e.lower else m.lower end as lower,
    case when won then e.upper else m.upper end as upper, case when won then null else m.mae end as mae,
    case when won then e.mape else m.mape end as mape
  from (select s.*, coalesce(e.mape < case when s.wf_mape = 0 then 9999 else s.wf_mape end * 0.95::double, false) as won
    from singles s join (select * from ensembles where step = 1) e using (company_id, target)) s
  join ensembles e using (company_id, target)
  join models m using (company_id, target, step) where m.fold = 'full' and m.model = s.model""",
    "singles",
    "ensembles",
    "models",
)
stage(
    "forecasts",
    f"""  select company_id, cast(date_trunc('quarter', last_date) + to_months(cast(3 * step as integer)) as date) as forecast_date,
    {rnd('r.forecast', 2)} as predicted_revenue, {rnd('p.forecast', 2)} as predicted_profit,
    {rnd('r.lower', 2)} as lower_bound, {rnd('r.upper', 2)} as upper_bound, r.label as model_used, r.mae, r.mape
  from (select * from winners where target = 'revenue') r join (select * from winners where target = 'profit') p
    using (company_id, step) join (select distinct company_id, last_date from series) using (company_id)""",
    "winners",
    "series",
)
# the ensemble of the held-out fold and its error on the rows held out
stage(
    "ensemble_errors",
    """  select company_id, target, avg(abs((y - forecast) / nullif(y, 0))) * 100 as wf_mape
  from (select company_id, target, step, sum(w * forecast) as forecast
    from models join (select company_id, target, model, (1 / mape) / sum(1 / mape) over (partition by company_id, target) as w
      from models where fold = 'held_out' and step = 1 and mape > 0) using (company_id, target, model)
    where fold = 'held_out' group by company_id, target, step) e
  join series s using (company_id, target) where s.t = s.n - 4 + step - 1 group by company_id, target""",
    "models",
    "series",
)
stage(
    "pairs",
    " union all ".join(f"select {KEY}, '{m}' as model, t, fitted from {m}_pairs" for m in LABELS)
    + f" union all select {KEY}, unnest(['arima', 'holt']), t, y from folds where t = 0",  # their levels start there
    *[f"{m}_pairs" for m in LABELS],
    "folds",
)
stage(
    "fitted_models",
    """  select company_id, case when w.model_name = 'ensemble' then l.model else w.model_name end as model
  from (select company_id, model_name from winners where target = 'revenue' and step = 1) w
  left join (select company_id, arg_min(model, (mape, position)) as model from weights where target = 'revenue' group by company_id) l using (company_id)""",
    "winners",
    "weights",
)
stage(
    "feed",
    """  select company_id, case target when 'revenue' then 'actual' else 'actual_profit' end as kind, date, y as value,
    cast(null as double) as lower, cast(null as double) as upper from series
  union all select company_id, 'fitted', date, fitted, null, null
    from fitted_models join pairs using (company_id, model) join series using (company_id, target, t) where target = 'revenue' and fold = 'full'
  union all select company_id, 'forecast', cast(date_trunc('quarter', last_date) + to_months(cast(3 * step as integer)) as date), forecast, lower, upper
    from winners join (select distinct company_id, target, last_date from series) using (company_id, target) where target = 'revenue'""",
    "series",
    "fitted_models",
    "pairs",
    "winners",
)
