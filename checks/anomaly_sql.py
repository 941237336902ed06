"""DuckDB stages of the rule-based detectors."""

from __future__ import annotations

from checks.sql import rnd, stage

Z_METRICS = ("revenue", "expenses", "profit", "operating_cost")


def _long(metrics) -> str:
    return " union all ".join(f"select company_id, date, '{m}' as metric, {m} as value from records" for m in metrics)


stage(
    "z_flags",
    f"""  select company_id, date, metric, {rnd('value', 2)} as value, {rnd('(value - m) / s', 3)} as z_score,
    case when abs((value - m) / s) > 3 then 'SEVERE' else 'WARNING' end as severity, 'Z-Score' as method
  from (select *, avg(value) over g as m, nullif(stddev_pop(value) over g, 0) as s, count(*) over g as n
    from ({_long(Z_METRICS)}) window g as (partition by company_id, metric))
  where n >= 4 and abs((value - m) / s) > 2""",
    "records",
)
stage(
    "iqr_flags",
    f"""  select company_id, date, metric, {rnd('value', 2)} as value, {rnd('(value - m) / coalesce(s, 1)', 3)} as z_score,
    'WARNING' as severity, 'IQR' as method
  from ({_long(Z_METRICS[:3])}) join (
    select company_id, metric, avg(value) as m, nullif(stddev_pop(value), 0) as s,
      quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
    from ({_long(Z_METRICS[:3])}) group by company_id, metric) using (company_id, metric)
  where value < q1 - 1.5::double * (q3 - q1) or value > q3 + 1.5::double * (q3 - q1)""",
    "records",
)
stage(
    "debt_flags",
    f"""  select company_id, date, 'debt_to_assets' as metric, {rnd('debt', 4)} as value,
    {rnd('(debt - (select avg(debt) from debts)) / coalesce(nullif((select stddev_samp(debt) from debts), 0), 1)', 3)} as z_score,
    case when debt > 0.80::double then 'SEVERE' else 'WARNING' end as severity, 'DebtRatioThreshold' as method
  from debts where debt > 0.70::double""",
    "debts",
)
stage("debts", "  select *, liabilities / nullif(assets, 0) as debt from records", "records")
stage(
    "rule_flags",
    "  select * from z_flags union all select * from iqr_flags union all select * from debt_flags",
    "z_flags",
    "iqr_flags",
    "debt_flags",
)


def most_severe(flags: str) -> str:
    """One flag per cell: SEVERE first, then by method order."""
    return f"""  select company_id, date, metric, value, z_score, severity from (
    select *, row_number() over (partition by company_id, date, metric order by severity,
      list_position(['Z-Score', 'IQR', 'IsolationForest', 'DebtRatioThreshold'], method)) as pick from {flags})
  where pick = 1"""


stage("kept_rule_flags", most_severe("rule_flags"), "rule_flags")

# Isolation forest: every row of a company in every tree, one stage per level. A node's split comes from
# the rows that are in the tree's sample, all other rows follow it.

TREES, SAMPLE = 100, 256
_LEVELS = range(SAMPLE.bit_length())


def _part(digest: str, at: int) -> str:
    return f"cast('0x' || substr({digest}, {at}, 8) as bigint)"


def usual_depth(n: str) -> str:
    """c(n) of the forest in millionths."""
    general = f"(2 * (ln(greatest({n}, 3) - 1) + 0.5772156649015329::double) - 2 * (greatest({n}, 3) - 1)::double / greatest({n}, 3))"
    return f"cast(case when {n} > 2 then round({general} * 1000000) when {n} = 2 then 1000000 else 0 end as bigint)"


_OF_TREE = f"""  select *, company_id || ':' || tree as place, n <= {SAMPLE} or row_number() over (partition by company_id, tree
      order by {_part("md5(company_id || ':' || tree || ':' || date)", 1)}, date) <= {SAMPLE} as sampled,
    0 as node, 0 as steps, length(bin(least(n, {SAMPLE}) - 1)) as most
  from (select company_id, date, {', '.join(Z_METRICS)}, count(*) over (partition by company_id) as n from records), range({TREES}) as t(tree)
  where n >= 6"""
stage("iso_rows0", _OF_TREE, "records")
_LOW, _HIGH = ("[" + ", ".join(f"{f}({m}) filter (where sampled)" for m in Z_METRICS) + "]" for f in ("min", "max"))
for _level in _LEVELS:
    stage(
        f"iso_nodes{_level}",
        f"""  select *, uneven[(({_part('digest', 1)} * len(uneven)) >> 32) + 1] as feature, {_part('digest', 9)} / 4294967296::double as share
  from (select *, list_filter([1, 2, 3, 4], lambda k: steps < most and high[k] > low[k]) as uneven, md5(place || ':' || node) as digest
    from (select place, node, any_value(steps) as steps, any_value(most) as most, count_if(sampled) as size, {_LOW} as low, {_HIGH} as high
      from iso_rows{_level} group by place, node))""",
        f"iso_rows{_level}",
    )
    stage(
        f"iso_rows{_level + 1}",
        f"""  select r.* exclude (node, steps), r.steps + 1 as steps,
    2 * r.node + 1 + cast([{', '.join(Z_METRICS)}][feature] > low[feature] + share * (high[feature] - low[feature]) as int) as node
  from iso_rows{_level} r join iso_nodes{_level} n on r.place = n.place and r.node = n.node where len(uneven) > 0""",
        f"iso_rows{_level}",
        f"iso_nodes{_level}",
    )
stage(
    "iso_paths",
    "  select company_id, date, n, any_value(columns(['revenue', 'expenses', 'profit', 'operating_cost'])), sum(path)::bigint as path from ("
    + " union all ".join(
        f"select company_id, date, n, {', '.join(Z_METRICS)}, r.steps * 1000000 + {usual_depth('size')} as path "
        f"from iso_rows{k} r join iso_nodes{k} m on r.place = m.place and r.node = m.node where len(uneven) = 0"
        for k in _LEVELS
    )
    + ") group by company_id, date, n",
    *[f"iso_nodes{k}" for k in _LEVELS],
)
_DEVIATIONS = ", ".join(f"abs({m} - avg({m}) over g) / (stddev_pop({m}) over g + 1e-9::double)" for m in Z_METRICS)
stage(
    "iso_flags",
    f"""  select company_id, date, ['revenue', 'expenses', 'profit', 'operating_cost'][k] as metric,
    {rnd('[revenue, expenses, profit, operating_cost][k]', 2)} as value, {rnd('score', 3)} as z_score, 'WARNING' as severity, 'IsolationForest' as method
  from (select *, list_position(deviations, list_max(deviations)) as k
    from (select *, pow(2::double, -(path / ({TREES} * {usual_depth(f'least(n, {SAMPLE})')})::double)) as score,
        path < quantile_cont(path, 0.08) over g as isolated, [{_DEVIATIONS}] as deviations
      from iso_paths window g as (partition by company_id)))
  where isolated""",
    "iso_paths",
)
stage("all_flags", "  select * from rule_flags union all select * from iso_flags", "rule_flags", "iso_flags")
stage("flags", most_severe("all_flags"), "all_flags")
