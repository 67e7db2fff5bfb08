"""Expected results in SQL, written on their own from the test tables."""

from __future__ import annotations

import re


# Fixed values, written out a second time so that a wrong entry in the engine shows: states with the year of their Medicaid
# expansion, eras, policy events, Census columns, metrics.
STATES = [
    ("01", "Alabama", "AL", "South", "East South Central", None),
    ("02", "Alaska", "AK", "West", "Pacific", 2015),
    ("04", "Arizona", "AZ", "West", "Mountain", 2014),
    ("05", "Arkansas", "AR", "South", "West South Central", 2014),
    ("06", "California", "CA", "West", "Pacific", 2014),
    ("08", "Colorado", "CO", "West", "Mountain", 2014),
    ("09", "Connecticut", "CT", "Northeast", "New England", 2014),
    ("10", "Delaware", "DE", "South", "South Atlantic", 2014),
    ("11", "District of Columbia", "DC", "South", "South Atlantic", 2014),
    ("12", "Florida", "FL", "South", "South Atlantic", None),
    ("13", "Georgia", "GA", "South", "South Atlantic", None),
    ("15", "Hawaii", "HI", "West", "Pacific", 2014),
    ("16", "Idaho", "ID", "West", "Mountain", 2020),
    ("17", "Illinois", "IL", "Midwest", "East North Central", 2014),
    ("18", "Indiana", "IN", "Midwest", "East North Central", 2015),
    ("19", "Iowa", "IA", "Midwest", "West North Central", 2014),
    ("20", "Kansas", "KS", "Midwest", "West North Central", None),
    ("21", "Kentucky", "KY", "South", "East South Central", 2014),
    ("22", "Louisiana", "LA", "South", "West South Central", 2016),
    ("23", "Maine", "ME", "Northeast", "New England", 2019),
    ("24", "Maryland", "MD", "South", "South Atlantic", 2014),
    ("25", "Massachusetts", "MA", "Northeast", "New England", 2014),
    ("26", "Michigan", "MI", "Midwest", "East North Central", 2014),
    ("27", "Minnesota", "MN", "Midwest", "West North Central", 2014),
    ("28", "Mississippi", "MS", "South", "East South Central", None),
    ("29", "Missouri", "MO", "Midwest", "West North Central", 2021),
    ("30", "Montana", "MT", "West", "Mountain", 2016),
    ("31", "Nebraska", "NE", "Midwest", "West North Central", 2020),
    ("32", "Nevada", "NV", "West", "Mountain", 2014),
    ("33", "New Hampshire", "NH", "Northeast", "New England", 2014),
    ("34", "New Jersey", "NJ", "Northeast", "Middle Atlantic", 2014),
    ("35", "New Mexico", "NM", "West", "Mountain", 2014),
    ("36", "New York", "NY", "Northeast", "Middle Atlantic", 2014),
    ("37", "North Carolina", "NC", "South", "South Atlantic", 2023),
    ("38", "North Dakota", "ND", "Midwest", "West North Central", 2014),
    ("39", "Ohio", "OH", "Midwest", "East North Central", 2014),
    ("40", "Oklahoma", "OK", "South", "West South Central", 2021),
    ("41", "Oregon", "OR", "West", "Pacific", 2014),
    ("42", "Pennsylvania", "PA", "Northeast", "Middle Atlantic", 2015),
    ("44", "Rhode Island", "RI", "Northeast", "New England", 2014),
    ("45", "South Carolina", "SC", "South", "South Atlantic", None),
    ("46", "South Dakota", "SD", "Midwest", "West North Central", 2023),
    ("47", "Tennessee", "TN", "South", "East South Central", None),
    ("48", "Texas", "TX", "South", "West South Central", None),
    ("49", "Utah", "UT", "West", "Mountain", 2020),
    ("50", "Vermont", "VT", "Northeast", "New England", 2014),
    ("51", "Virginia", "VA", "South", "South Atlantic", 2019),
    ("53", "Washington", "WA", "West", "Pacific", 2014),
    ("54", "West Virginia", "WV", "South", "South Atlantic", 2014),
    ("55", "Wisconsin", "WI", "Midwest", "East North Central", None),
    ("56", "Wyoming", "WY", "West", "Mountain", None),
]
ERAS = [
    ("Trump1", "Trump", 2017, 2020, "#e31a1c"), ("Biden", "Biden", 2021, 2024, "#1f78b4"), ("Trump2", "Trump", 2025, 2027, "#fc8d59"),
]
POLICY_EVENTS = [
    (2019, "ACA individual mandate penalty repealed"), (2020, "COVID-19: continuous coverage requirement (Mar)"),
    (2021, "American Rescue Plan ACA subsidy expansion"), (2023, "Medicaid unwinding begins (Apr)"),
    (2024, "Medicaid unwinding ends (Jun); enrollment drops"), (2025, "Trump2 Medicaid work requirements / DOGE cuts"),
]
ACS_NAMES = [
    "median_household_income", "n_below_poverty", "poverty_universe", "edu_universe", "edu_hs_diploma", "edu_bachelors",
    "renters_total", "renters_severe_burden",
]
METRICS = {
    "weighted_avg_pct_uninsured": "sum(n_uninsured) / nullif(sum(sahie_total_population), 0)",
    "weighted_avg_unemployment_rate": "sum(unemployment_level) / nullif(sum(labor_force_level), 0)",
    "weighted_avg_poverty_rate": "sum(n_below_poverty) / nullif(sum(poverty_universe), 0)",
    "weighted_avg_pct_bachelors_plus": "sum(edu_bachelors) / nullif(sum(edu_universe), 0)",
    "weighted_avg_pct_hs_plus": "sum(edu_hs_diploma + edu_bachelors) / nullif(sum(edu_universe), 0)",
    "weighted_avg_pct_severe_rent_burden": "sum(renters_severe_burden) / nullif(sum(renters_total), 0)",
    "avg_median_household_income": "avg(median_household_income)",
    "weighted_avg_mds_rate_per_100k": "sum(total_mds) / nullif(sum(total_population), 0) * 100000",
    "avg_dist_trauma_center_miles": "avg(dist_trauma_center_miles)",
    "avg_dist_obstetrics_miles": "avg(dist_obstetrics_miles)",
}


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)


def _zfill(text: str, width: int) -> str:
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


def _num(text: str) -> str:
    return f"CASE WHEN lower({text}) NOT LIKE '%nan%' THEN TRY_CAST({text} AS DOUBLE) END"


def _share(top: str, bottom: str) -> str:
    return f"{top} / nullif({bottom}, 0)"


KEY = "md5(county_fips || '-' || CAST(year AS VARCHAR)) AS county_year_key"
YEAR = "CAST(year(o_orderdate) + 21 AS BIGINT)"

# Relations that several expected results build on; each may use the ones before it.
RELATIONS = {
    "states": f"""
        SELECT * FROM (VALUES {_values([s[:5] for s in STATES])})
        AS v(state_fips, state_name, state_abbr, census_region, census_division)""",
    "expansion": f"""
        SELECT state_fips, state_name, state_abbr,
               CASE WHEN y IS NULL THEN 'not_expanded' ELSE 'expanded' END AS expansion_status,
               CAST(y AS BIGINT) AS expansion_year
        FROM (VALUES {_values([(*s[:3], s[5]) for s in STATES])}) AS v(state_fips, state_name, state_abbr, y)""",
    "eras": f"""
        SELECT era_name, president, CAST(s AS BIGINT) AS start_year, CAST(e AS BIGINT) AS end_year, color_hex
        FROM (VALUES {_values(ERAS)}) AS v(era_name, president, s, e, color_hex)""",
    "places": """
        SELECT c_custkey, lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS st,
               lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS co
        FROM customer""",
    "counts": f"""
        SELECT st, co, {YEAR} AS year, count(*) AS n_all, count(DISTINCT o_custkey) AS customers,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
               count(*) FILTER (WHERE o_orderstatus = 'P') AS n_p,
               count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW') AS n_p_low,
               count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
               count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS n_high,
               count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS n_medium
        FROM orders JOIN places ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
    "sahie_payload": """
        SELECT ltrim(st || co, '0') AS geoid, 'County ' || st || co AS name,
               CASE WHEN n_all < 3 THEN 'N/A' ELSE CAST((100 * n_f) // n_all AS VARCHAR) END AS pctui_pt,
               CASE WHEN n_all < 3 THEN 'N/A' ELSE CAST(n_f AS VARCHAR) END AS nui_pt,
               CASE WHEN n_all < 3 THEN 'N/A' ELSE CAST(n_all - n_f AS VARCHAR) END AS nic_pt,
               CAST(year AS VARCHAR) AS time, '0' AS agecat, '0' AS sexcat, '0' AS iprcat,
               st AS state, co AS county, year
        FROM counts""",
    "sahie_raw": f"""
        SELECT {_zfill('geoid', 5)} AS geoid, name, {_num('pctui_pt')} AS pctui_pt, {_num('nui_pt')} AS nui_pt,
               {_num('nic_pt')} AS nic_pt, time, agecat, sexcat, iprcat, state, county, year
        FROM sahie_payload""",
    "stg_sahie": f"""
        SELECT md5(geoid || '-' || time) AS county_year_key, geoid AS county_fips,
               substr(geoid, 1, 2) AS state_fips, name AS county_name, year,
               pctui_pt / 100.0 AS pct_uninsured, nui_pt AS n_uninsured, nic_pt AS n_insured,
               nui_pt + nic_pt AS sahie_total_population
        FROM sahie_raw WHERE year BETWEEN 2017 AND 2022 AND geoid NOT LIKE '%000'""",
    "bls_series": """
        SELECT 'LAUCN' || st || co || m AS series_id, CASE WHEN co = '000' THEN 'A' ELSE 'F' END AS area_type_code,
               'CN' || st || co || '00000000' AS area_code, m AS measure_code
        FROM (SELECT DISTINCT st, co FROM places), (VALUES ('03'), ('04'), ('05'), ('06')) AS v(m)""",
    "bls_data": """
        SELECT 'LAUCN' || st || co || m AS series_id, CAST(year AS VARCHAR) AS year, period,
               CAST(CASE m WHEN '03' THEN (100 * n_f) // n_all WHEN '04' THEN n_f WHEN '05' THEN n_p ELSE n_all END
                    + extra AS VARCHAR) AS value
        FROM counts, (VALUES ('03'), ('04'), ('05'), ('06')) AS v(m),
             (VALUES ('M13', 0), ('M01', 7)) AS p(period, extra)""",
    "bls_raw": """
        SELECT st || co AS county_fips, st AS state_fips, co AS county_fips_within_state, year,
               CAST((100 * n_f) // n_all AS DOUBLE) AS unemployment_rate,
               CAST(n_f AS DOUBLE) AS unemployment_level, CAST(n_all AS DOUBLE) AS labor_force_level
        FROM counts WHERE co <> '000'""",
    "stg_bls": f"""
        SELECT {KEY}, county_fips, state_fips, year, unemployment_rate, unemployment_level, labor_force_level
        FROM bls_raw WHERE year BETWEEN 2017 AND 2024""",
    "acs_payload": """
        SELECT 'County ' || st || co AS name,
               CASE CAST(co AS INT) % 7 WHEN 0 THEN '-666666666' WHEN 1 THEN 'NaN' WHEN 2 THEN ' nan'
                    ELSE CAST(30000 + 1000 * CAST(co AS INT) + (year - 2016) AS VARCHAR) END AS median_household_income,
               CAST(n_urgent AS VARCHAR) AS n_below_poverty, CAST(n_all AS VARCHAR) AS poverty_universe,
               CAST(n_all AS VARCHAR) AS edu_universe, CAST(n_high AS VARCHAR) AS edu_hs_diploma,
               CAST(n_medium AS VARCHAR) AS edu_bachelors, CAST(n_p AS VARCHAR) AS renters_total,
               CAST(n_p_low AS VARCHAR) AS renters_severe_burden, st AS state, co AS county, year
        FROM counts""",
    "acs_numbers": f"""
        SELECT name, {', '.join(f"CASE WHEN {_num(c)} >= 0 THEN {_num(c)} END AS {c}" for c in ACS_NAMES)},
               state, county, year, state || county AS county_fips, state AS state_fips
        FROM acs_payload""",
    "acs_raw": f"""
        SELECT *, {_share('n_below_poverty', 'poverty_universe')} AS poverty_rate,
               {_share('edu_bachelors', 'edu_universe')} AS pct_bachelors_plus,
               {_share('(edu_hs_diploma + edu_bachelors)', 'edu_universe')} AS pct_hs_plus,
               {_share('renters_severe_burden', 'renters_total')} AS pct_severe_rent_burden
        FROM acs_numbers""",
    "stg_acs": f"""
        SELECT {KEY}, county_fips, state_fips, year, median_household_income, poverty_rate, n_below_poverty,
               poverty_universe, pct_bachelors_plus, pct_hs_plus, edu_bachelors, edu_hs_diploma, edu_universe,
               pct_severe_rent_burden, renters_severe_burden, renters_total
        FROM acs_raw WHERE year BETWEEN 2017 AND 2022 AND county <> '000'""",
    "ahrq_raw": """
        SELECT st || co AS county_fips, year, CAST(n_f AS DOUBLE) AS pct_uninsured_under65,
               CAST(NULL AS DOUBLE) AS median_hh_income, CAST(NULL AS DOUBLE) AS pct_below_poverty,
               CAST(NULL AS DOUBLE) AS pct_unemployed, CAST(NULL AS DOUBLE) AS pct_hs_graduate,
               CAST(NULL AS DOUBLE) AS pct_bachelors, CAST(1000 * customers AS DOUBLE) AS total_population,
               CAST(5 * CAST(co AS INT) AS DOUBLE) AS dist_trauma_center_miles,
               CASE WHEN year >= 2019 THEN CAST(3 * CAST(co AS INT) AS DOUBLE) END AS dist_obstetrics_miles,
               CAST(NULL AS DOUBLE) AS mds_rate_per_100k, CAST(n_all - n_f AS DOUBLE) AS total_mds,
               CAST(CAST(co AS INT) % 3 AS DOUBLE) AS hpsa_primary_care,
               CAST(1 + CAST(co AS INT) % 10 AS DOUBLE) AS rural_urban_code_2013,
               CAST(NULL AS DOUBLE) AS rural_urban_code_2023
        FROM counts""",
    "stg_ahrq": f"""
        SELECT {KEY}, county_fips, year, pct_uninsured_under65, dist_trauma_center_miles, dist_obstetrics_miles,
               mds_rate_per_100k, total_mds, total_population, CAST(hpsa_primary_care AS BIGINT) AS hpsa_primary_care,
               CAST(rural_urban_code_2013 AS BIGINT) AS rural_urban_code_2013,
               CASE WHEN rural_urban_code_2013 >= 4 THEN true WHEN rural_urban_code_2013 >= 1 THEN false END AS is_rural
        FROM ahrq_raw WHERE year > 2016""",
    "latest_ahrq": """
        SELECT * FROM stg_ahrq QUALIFY row_number() OVER (PARTITION BY county_fips ORDER BY year DESC) = 1""",
    "dim_county": """
        SELECT c.county_fips, c.county_name, c.state_fips, s.state_name, s.state_abbr, s.census_region,
               s.census_division, e.expansion_status, e.expansion_year,
               e.expansion_status = 'expanded' AS is_expansion_state, a.rural_urban_code_2013, a.is_rural
        FROM (SELECT DISTINCT county_fips, state_fips, county_name FROM stg_sahie) c
        LEFT JOIN states s USING (state_fips)
        LEFT JOIN expansion e ON c.state_fips = e.state_fips
        LEFT JOIN latest_ahrq a ON c.county_fips = a.county_fips""",
    "events_of_years": f"""
        SELECT CAST(y AS BIGINT) AS year, label FROM (VALUES {_values(POLICY_EVENTS)}) AS v(y, label)""",
    "dim_year": """
        SELECT y.year, era_name, president, color_hex AS era_color_hex, label AS policy_event_label
        FROM (SELECT range AS year FROM range(2017, 2026)) y
        LEFT JOIN eras ON y.year BETWEEN start_year AND end_year
        LEFT JOIN events_of_years l ON l.year = y.year""",
    "fct": """
        SELECT s.county_year_key, s.county_fips, s.year, n_uninsured, n_insured, sahie_total_population,
               unemployment_level, labor_force_level, n_below_poverty, poverty_universe, edu_bachelors,
               edu_hs_diploma, edu_universe, renters_severe_burden, renters_total, median_household_income,
               total_mds, total_population, dist_trauma_center_miles, dist_obstetrics_miles, hpsa_primary_care
        FROM stg_sahie s
        LEFT JOIN stg_bls b ON s.county_year_key = b.county_year_key
        LEFT JOIN stg_acs a ON s.county_year_key = a.county_year_key
        LEFT JOIN stg_ahrq h ON s.county_year_key = h.county_year_key AND h.year <= 2020""",
    "star": """
        SELECT fct.*, d.* EXCLUDE (county_fips), y.* EXCLUDE (year)
        FROM fct JOIN dim_county d USING (county_fips) JOIN dim_year y USING (year)""",
    "trends": f"""
        SELECT county_fips, county_name, state_abbr, state_name, census_region, is_expansion_state,
               expansion_status, year, era_name, era_color_hex,
               {_share('n_uninsured', 'sahie_total_population')} AS pct_uninsured,
               {_share('unemployment_level', 'labor_force_level')} AS unemployment_rate,
               {_share('n_below_poverty', 'poverty_universe')} AS poverty_rate, median_household_income,
               {_share('edu_bachelors', 'edu_universe')} AS pct_bachelors_plus,
               {_share('renters_severe_burden', 'renters_total')} AS pct_severe_rent_burden, policy_event_label
        FROM star""",
    "orders_by_year": f"SELECT {YEAR} AS year, count(*) AS n_orders FROM orders GROUP BY 1",
    "quantities": """
        SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year, sum(l_quantity) AS quantity,
               sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS returned
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
}


def _uses(sql: str) -> set[str]:
    return {name for name in RELATIONS if re.search(rf"\b{name}\b", sql)}


def with_relations(sql: str) -> str:
    """Prefix a query with the relations it uses, directly or through others."""
    needed, todo = set(), _uses(sql)
    while todo:
        needed |= todo
        todo = {u for name in todo for u in _uses(RELATIONS[name])} - needed
    parts = [f"{name} AS ({RELATIONS[name]})" for name in RELATIONS if name in needed]
    return (f"WITH {', '.join(parts)}\n" if parts else "") + sql


def _metric(name: str) -> str:
    return f"{METRICS[name]} AS {name}"


def _metrics(names: list[str], dims: list[str], where: str = "true") -> str:
    listed = ", ".join(dims)
    return f"SELECT {listed}, {', '.join(map(_metric, names))} FROM star WHERE {where} GROUP BY {listed}"


def _ratio(top: str, bottom: str, where: str) -> str:
    return f"sum({top}) FILTER (WHERE {where}) / nullif(sum({bottom}) FILTER (WHERE {where}), 0)"


def _county_changes(first: str, last: str, labels: tuple[str, str]) -> str:
    a, b = labels
    return f"""
        WITH rates AS (
            SELECT county_fips, min(county_name) AS county_name, min(state_abbr) AS state_abbr,
                   bool_and(is_expansion_state) AS is_expansion_state,
                   {_ratio('n_uninsured', 'sahie_total_population', first)} AS {a}_pct_uninsured,
                   {_ratio('n_uninsured', 'sahie_total_population', last)} AS {b}_pct_uninsured,
                   {_ratio('n_below_poverty', 'poverty_universe', first)} AS {a}_poverty_rate,
                   {_ratio('n_below_poverty', 'poverty_universe', last)} AS {b}_poverty_rate
            FROM star WHERE n_uninsured IS NOT NULL
            GROUP BY county_fips
            HAVING count(*) FILTER (WHERE {first}) > 0 AND count(*) FILTER (WHERE {last}) > 0),
        changes AS (
            SELECT *, {b}_pct_uninsured - {a}_pct_uninsured AS change_pct_uninsured,
                   {b}_poverty_rate - {a}_poverty_rate AS change_poverty_rate FROM rates)
        SELECT *, CASE WHEN change_pct_uninsured > 0.01 THEN 'deteriorated'
                       WHEN change_pct_uninsured < -0.01 THEN 'improved' ELSE 'stable' END AS uninsurance_trajectory
        FROM changes ORDER BY change_pct_uninsured DESC NULLS LAST, county_fips LIMIT 50"""


def _nested(sql: str) -> str:
    """Fold the relations into a query that already starts with WITH."""
    prefix = with_relations(sql)
    if not prefix.startswith("WITH ") or prefix == sql:
        return prefix
    body = sql.strip()
    return prefix.replace(sql, "").rstrip() + ", " + body.removeprefix("WITH ")


#: Spark's name for the type of a time column as it is stored.
TIME_TYPE = "(SELECT CASE WHEN any_value(typeof({column})) = 'TIMESTAMP' THEN 'timestamp_ntz' ELSE 'timestamp' END FROM {table})"
PERCENT = ["pct_uninsured", "unemployment_rate", "poverty_rate", "pct_bachelors_plus", "pct_severe_rent_burden"]


def _means(keys: str, extra: str = "") -> str:
    means = [f"round(avg({c}) * 100, 6) AS {c}" for c in PERCENT]
    means.append("round(avg(median_household_income), 6) AS median_household_income")
    present = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"SELECT {keys}{extra}, {', '.join(means)} FROM trends WHERE {present} GROUP BY {keys}"


def _all_groupings() -> str:
    """The three trends one below the other."""
    parts = []
    for keys in (("year", "era_name"), ("year", "expansion_status"), ("year", "era_name", "expansion_status")):
        named = ", ".join(k if k in keys else f"CAST(NULL AS VARCHAR) AS {k}" for k in ("year", "era_name", "expansion_status"))
        columns = ", ".join([*PERCENT, "median_household_income"])
        parts.append(f"SELECT '{', '.join(keys)}' AS grouped_by, {named}, {columns} FROM ({_means(', '.join(keys))})")
    return " UNION ALL ".join(parts)


def _check_types() -> str:
    """Wrong columns, written out; the rows are counted."""
    wrong = [
        ("orders", "o_custkey", "string", "bigint"), ("orders", "o_comment", "string", None), ("orders", "o_orderdate", None, None),
        ("nation", "n_nationkey", "bigint", "int"), ("nation", "n_regionkey", "bigint", "int"), ("events", "ts", "string", None),
        ("customer", "c_nationkey", "bigint", "int"),
    ]
    times = {("orders", "o_orderdate"), ("events", "ts")}
    text = lambda x: "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"
    found = lambda t, c, kind: TIME_TYPE.format(table=t, column=c) if (t, c) in times else text(kind)
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {text(e)} AS expected_type, {found(t, c, f)} AS found_type, "
        f"(SELECT count(*) FROM {t}) AS n_rows" for t, c, e, f in wrong)


def _people(seed: str) -> str:
    return f"""
        SELECT {seed}.*, coalesce(n, 0) AS n_customers FROM {seed}
        LEFT JOIN (SELECT st, count(*) AS n FROM places GROUP BY 1) ON st = state_fips"""


def _check(table: str, kind: str, column: str, failing: str, where: str = "") -> str:
    filtered = f" WHERE {where}" if where else ""
    return (
        f"SELECT '{table}' AS table_name, '{kind}' AS check_name, '{column}' AS column_name, "
        f"CAST({failing} AS BIGINT) AS failing_rows{filtered}"
    )


def _quality_report() -> str:
    names = {"fct_county_year": "fct", "state_fips_lookup": "states", "policy_eras": "eras",
             "medicaid_expansion_status": "expansion"}

    def count(table: str, where: str) -> str:
        return f"(SELECT count(*) FROM {names.get(table, table)} WHERE {where})"

    not_nulls = {
        "stg_sahie": "county_year_key county_fips state_fips year",
        "stg_bls": "county_year_key county_fips state_fips year unemployment_rate",
        "stg_acs": "county_year_key county_fips",
        "dim_county": "county_fips state_fips is_expansion_state",
        "dim_year": "year",
        "fct_county_year": "county_year_key county_fips year",
        "state_fips_lookup": "state_fips",
        "policy_eras": "era_name",
        "medicaid_expansion_status": "state_fips",
    }
    uniques = {
        "stg_sahie": "county_year_key", "stg_bls": "county_year_key", "stg_acs": "county_year_key",
        "dim_county": "county_fips", "dim_year": "year", "fct_county_year": "county_year_key",
        "state_fips_lookup": "state_fips", "policy_eras": "era_name", "medicaid_expansion_status": "state_fips",
    }
    lines = [
        _check(t, "not_null", c, count(t, f"{c} IS NULL")) for t, columns in not_nulls.items() for c in columns.split()
    ]
    lines.append(_check("stg_ahrq", "not_null", "county_fips", "0"))
    lines += [
        _check(t, "unique", c, f"(SELECT count(*) FROM (SELECT {c} FROM {names.get(t, t)} WHERE {c} IS NOT NULL "
               f"GROUP BY 1 HAVING count(*) > 1))")
        for t, c in uniques.items()
    ]
    lines += [
        _check("stg_sahie", "accepted_values", "year", count("stg_sahie", "year NOT BETWEEN 2017 AND 2022")),
        _check("dim_year", "accepted_values", "era_name",
               count("dim_year", "era_name NOT IN ('Trump1', 'Biden', 'Trump2')")),
        _check("medicaid_expansion_status", "accepted_values", "expansion_status",
               count("medicaid_expansion_status", "expansion_status NOT IN ('expanded', 'not_expanded')")),
        _check("stg_sahie", "between", "pct_uninsured", count("stg_sahie", "pct_uninsured < 0 OR pct_uninsured > 1")),
        _check("stg_bls", "between", "unemployment_rate",
               count("stg_bls", "unemployment_rate < 0 OR unemployment_rate > 60")),
        _check("stg_acs", "between", "poverty_rate", count("stg_acs", "poverty_rate < 0 OR poverty_rate > 1")),
        _check("fct_county_year", "relationships", "county_fips",
               count("fct_county_year", "county_fips NOT IN (SELECT county_fips FROM dim_county)")),
        _check("fct_county_year", "relationships", "year",
               count("fct_county_year", "year NOT IN (SELECT year FROM dim_year)")),
        _check("fct_county_year", "part_of_whole", "n_uninsured",
               count("fct_county_year", "n_uninsured < 0 OR sahie_total_population < 0 "
                     "OR n_uninsured > sahie_total_population")),
    ]
    return "\nUNION ALL ".join(lines)


def _diff_in_diff() -> str:
    outcomes = {
        "weighted_avg_pct_uninsured": ("n_uninsured", "sahie_total_population"),
        "weighted_avg_unemployment_rate": ("unemployment_level", "labor_force_level"),
        "weighted_avg_poverty_rate": ("n_below_poverty", "poverty_universe"),
        "weighted_avg_pct_severe_rent_burden": ("renters_severe_burden", "renters_total"),
    }
    cells = {
        "expanded_before": "is_expansion_state AND era_name = 'Trump1'",
        "expanded_after": "is_expansion_state AND era_name = 'Biden'",
        "other_before": "NOT is_expansion_state AND era_name = 'Trump1'",
        "other_after": "NOT is_expansion_state AND era_name = 'Biden'",
    }
    rows = []
    for name, (top, bottom) in outcomes.items():
        listed = ", ".join(f"{_ratio(top, bottom, where)} AS {cell}" for cell, where in cells.items())
        rows.append(f"SELECT '{name}' AS outcome, {listed} FROM star")
    return f"""
        SELECT *, (expanded_after - expanded_before) - (other_after - other_before) AS diff_in_diff
        FROM ({' UNION ALL '.join(rows)})"""


def _era_orders(shift: int, moved: int = 0, columns: str = "era_name, president") -> str:
    year = f"CAST(year(o_orderdate) + {shift} AS BIGINT)"
    return f"""
        SELECT o_orderkey, {year} AS year, {columns} FROM orders
        LEFT JOIN eras ON {year} BETWEEN start_year - {moved} AND end_year - {moved}"""


_NEW_LAYOUT = "FROM counts WHERE year >= 2019"
_AHRQ_TEXT = {
    "county_fips": "st || co", "year": "year || '.0'", "total_population": "CAST(customers * 1000 AS VARCHAR)",
    "total_mds": "CAST(n_all - n_f AS VARCHAR)", "rucc": "CAST(1 + CAST(co AS INT) % 10 AS VARCHAR)",
    "hpsa": "CAST(CAST(co AS INT) % 3 AS VARCHAR)", "trauma": "CAST(5 * CAST(co AS INT) AS VARCHAR)",
    "obstetrics": "CAST(3 * CAST(co AS INT) AS VARCHAR)", "uninsured": "CAST(n_f AS VARCHAR)",
}


def _alias_resolve() -> str:
    v = _AHRQ_TEXT
    return f"""
        SELECT {v['county_fips']} AS county_fips, {v['year']} AS year, {v['uninsured']} AS pct_uninsured_under65,
               CAST(NULL AS VARCHAR) AS median_hh_income, CAST(NULL AS VARCHAR) AS pct_below_poverty,
               CAST(NULL AS VARCHAR) AS pct_unemployed, CAST(NULL AS VARCHAR) AS pct_hs_graduate,
               CAST(NULL AS VARCHAR) AS pct_bachelors, {v['total_population']} AS total_population,
               {v['trauma']} AS dist_trauma_center_miles, {v['obstetrics']} AS dist_obstetrics_miles,
               CAST(NULL AS VARCHAR) AS mds_rate_per_100k, {v['total_mds']} AS total_mds,
               {v['hpsa']} AS hpsa_primary_care, {v['rucc']} AS rural_urban_code_2013,
               CAST(NULL AS VARCHAR) AS rural_urban_code_2023 {_NEW_LAYOUT}"""


def _union_by_name() -> str:
    v = _AHRQ_TEXT
    common = f"""{v['year']} AS YEAR, {v['total_population']} AS ACS_TOT_POP_WT, {v['total_mds']} AS AHRF_TOT_MDS,
               {v['trauma']} AS POS_MEDIAN_DIST_TRAUMA, {v['rucc']} AS AHRF_USDA_RUCC_2013,
               {v['hpsa']} AS AHRF_HPSA_PRIM"""
    return f"""
        SELECT {v['county_fips']} AS FIPSCODE, {common}, {v['uninsured']} AS ACS_PCT_UNINSURED,
               NULL AS COUNTYFIPS, NULL AS POS_MEDIAN_DIST_OBSTETRICS, NULL AS SAHIE_PCT_UNINSURED64
        FROM counts WHERE year <= 2018
        UNION ALL BY NAME
        SELECT {v['county_fips']} AS COUNTYFIPS, {common}, {v['total_mds']} AS ACS_PCT_UNINSURED,
               {v['obstetrics']} AS POS_MEDIAN_DIST_OBSTETRICS, {v['uninsured']} AS SAHIE_PCT_UNINSURED64 {_NEW_LAYOUT}"""


def _gen_quality_report() -> str:
    def rows(table: str, where: str) -> str:
        return f"(SELECT count(*) FROM {table} WHERE {where})"

    def repeated(table: str, column: str) -> str:
        return f"(SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY 1 HAVING count(*) > 1))"

    lines = [
        _check("orders", "not_null", "o_custkey", rows("orders", "o_custkey IS NULL")),
        _check("orders", "unique", "o_orderkey", repeated("orders", "o_orderkey")),
        _check("orders", "accepted_values", "o_orderstatus", rows("orders", "o_orderstatus NOT IN ('F', 'O')")),
        _check("orders", "between", "o_totalprice",
               rows("orders", "o_orderstatus = 'F' AND (o_totalprice < 1000 OR o_totalprice > 400000)")),
        _check("orders", "relationships", "o_custkey", rows("orders", "o_custkey NOT IN (SELECT c_custkey FROM customer)")),
        _check("lineitem", "not_null", "l_shipdate", rows("lineitem", "l_shipdate IS NULL")),
        _check("lineitem", "between", "l_discount", rows("lineitem", "l_discount < 0 OR l_discount > 0.05")),
        _check("lineitem", "part_of_whole", "l_tax",
               rows("lineitem", "l_tax < 0 OR l_discount < 0 OR l_tax > l_discount")),
        _check("lineitem", "relationships", "l_partkey",
               rows("lineitem", "l_partkey NOT IN (SELECT p_partkey FROM part)")),
        _check("lineitem", "unique", "l_orderkey", repeated("lineitem", "l_orderkey")),
        _check("customer", "unique", "c_custkey", repeated("customer", "c_custkey")),
        _check("customer", "between", "c_acctbal", rows("customer", "c_acctbal < 0 OR c_acctbal > 9000")),
    ]
    return "\nUNION ALL ".join(lines)


WEIGHTED = [n for n in METRICS if n.startswith("weighted")]
STATE_OF = "lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0')"

EXPECTED = {
    "src_json_matrix": "SELECT * FROM sahie_payload",
    "src_json_matrix_rows": "SELECT * FROM sahie_payload",
    "src_category_filter": "SELECT * FROM sahie_payload",
    "src_tsv_trim": "SELECT * FROM bls_data",
    "src_tsv_malformed": """
        SELECT CASE WHEN kind > 1 THEN series_id END AS series_id, CASE WHEN kind > 1 THEN year END AS year,
               CASE WHEN kind > 1 THEN period END AS period,
               CASE WHEN kind = 3 THEN value || chr(9) || 'x' WHEN kind > 1 THEN value END AS value,
               CASE kind WHEN 0 THEN series_id || chr(9) || year || chr(9) || period
                         WHEN 1 THEN series_id || chr(9) || year || chr(9) || period || chr(9) || value || chr(9) || 'extra' END AS line
        FROM (SELECT *, CAST(value AS BIGINT) % 7 AS kind FROM bls_data)""",
    "src_multi_schema_union": "SELECT * FROM ahrq_raw",
    "sink_rowcount": "SELECT 'sahie_uninsured' AS table_name, count(*) AS n_rows FROM sahie_raw",
    "sink_landed_years": """
        SELECT * REPLACE (CASE WHEN year IN (2018, 2020) THEN 'Again ' || name ELSE name END AS name) FROM sahie_raw""",
    "panel_build": "SELECT * FROM fct",
    "optional_source_empty": """
        SELECT * REPLACE (CAST(NULL AS DOUBLE) AS total_mds, CAST(NULL AS DOUBLE) AS total_population,
               CAST(NULL AS DOUBLE) AS dist_trauma_center_miles, CAST(NULL AS DOUBLE) AS dist_obstetrics_miles,
               CAST(NULL AS BIGINT) AS hpsa_primary_care) FROM fct""",
    "seed_states": _people("states"),
    "seed_expansion": _people("expansion"),
    "seed_eras": """
        SELECT eras.*, CAST((SELECT coalesce(sum(n_orders), 0) FROM orders_by_year
               WHERE year BETWEEN start_year AND end_year) AS BIGINT) AS n_orders FROM eras""",
    "gen_year_spine": """
        SELECT y.year, coalesce(n_orders, 0) AS n_orders FROM (SELECT range AS year FROM range(2017, 2026)) y
        LEFT JOIN orders_by_year o ON o.year = y.year""",
    "dim_year": """
        SELECT dim_year.*, coalesce(n_orders, 0) AS n_orders FROM dim_year LEFT JOIN orders_by_year USING (year)""",
    "fct_county_year": "SELECT * FROM fct",
    "distinct_counties": "SELECT DISTINCT county_fips, state_fips, county_name FROM stg_sahie",
    "star_join": """
        SELECT county_fips, year, county_name, state_abbr, era_name, n_uninsured, labor_force_level FROM star""",
    "fips_pad": f"""
        SELECT c_custkey, lpad(CAST(c_custkey * 100 AS VARCHAR), 5, '0') AS county_fips, {STATE_OF} AS state_fips
        FROM customer""",
    "zfill": f"SELECT o_orderkey, {_zfill('CAST(o_orderkey * 100 AS VARCHAR)', 5)} AS code FROM orders",
    "fips_split": """
        SELECT series_id, substr(area_code, 3, 2) AS state_fips, substr(area_code, 5, 3) AS county_code,
               substr(series_id, 6, 2) AS state_part, substr(series_id, 8, 3) AS county_part FROM bls_series""",
    "fips_concat": f"""
        SELECT c_custkey, {STATE_OF} || {_zfill('CAST(c_custkey AS VARCHAR)', 3)} AS county_fips FROM customer""",
    "to_numeric": """
        SELECT geoid, year, TRY_CAST(pctui_pt AS DOUBLE) AS pctui_pt, TRY_CAST(nui_pt AS DOUBLE) AS nui_pt,
               TRY_CAST(nic_pt AS DOUBLE) AS nic_pt FROM sahie_payload""",
    "safe_cast": """
        SELECT geoid, year, TRY_CAST(pctui_pt AS DOUBLE) AS pctui_pt, TRY_CAST(nui_pt AS DOUBLE) AS nui_pt,
               TRY_CAST(nic_pt AS DOUBLE) AS nic_pt FROM sahie_payload""",
    "sentinel_null": """
        SELECT state, county, year, nullif(CAST(median_household_income AS DOUBLE), -666666666)
               AS median_household_income FROM acs_payload""",
    "neg_to_null": "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer",
    "acs_rates": """
        SELECT county_fips, year, poverty_rate, pct_bachelors_plus, pct_hs_plus, pct_severe_rent_burden FROM acs_raw""",
    "rural_flag": """
        SELECT p_partkey, CASE WHEN p_size >= 4 THEN true WHEN p_size BETWEEN 1 AND 3 THEN false END AS is_rural
        FROM part""",
    "expansion_flag": """
        SELECT st AS state_fips, c_custkey, expansion_status, expansion_year,
               expansion_status = 'expanded' AS is_expansion_state
        FROM places LEFT JOIN expansion ON st = state_fips""",
    "policy_event_label": """
        SELECT o_orderkey, CAST(year(o_orderdate) + 24 AS BIGINT) AS year, label AS policy_event_label
        FROM orders LEFT JOIN events_of_years e ON e.year = year(o_orderdate) + 24""",
    "trajectory_class": """
        SELECT l_orderkey, l_linenumber, l_discount - l_tax AS change,
               CASE WHEN l_discount - l_tax > 0.01 THEN 'deteriorated'
                    WHEN l_discount - l_tax < -0.01 THEN 'improved' ELSE 'stable' END AS trajectory FROM lineitem""",
    "era_of_year": """
        SELECT o_orderkey, CAST(year(o_orderdate) + 20 AS BIGINT) AS year, coalesce(era_name, 'pre-era') AS era
        FROM orders LEFT JOIN eras ON year(o_orderdate) + 20 BETWEEN start_year AND end_year""",
    "surrogate_key": """
        SELECT l_orderkey, l_linenumber, md5(l_orderkey || '-' || l_linenumber) AS line_key FROM lineitem""",
    "to_pct": f"""
        SELECT county_fips, year, {', '.join(f'{c} * 100 AS {c}' for c in PERCENT)}, median_household_income
        FROM trends""",
    "filter_year_window": f"SELECT o_orderkey, {YEAR} AS year FROM orders WHERE {YEAR} BETWEEN 2017 AND 2020",
    "filter_aggregate_rows": """
        SELECT lpad(geoid, 5, '0') AS county_fips, name, year FROM sahie_payload WHERE county <> '000'""",
    "rename_map": "SELECT * FROM acs_payload",
    "alias_resolve": _alias_resolve(),
    "union_by_name": _union_by_name(),
    "join_state_lookup": """
        SELECT p.st AS state_fips, c_custkey, s.state_name, s.state_abbr, census_region, census_division,
               expansion_status, expansion_year, expansion_status = 'expanded' AS is_expansion_state
        FROM places p LEFT JOIN states s ON p.st = s.state_fips LEFT JOIN expansion e ON p.st = e.state_fips""",
    "range_join_era": _era_orders(21),
    "range_join_exploded": _era_orders(21),
    "semi_join_series": """
        SELECT * FROM bls_data WHERE series_id IN (
            SELECT series_id FROM bls_series WHERE area_type_code = 'F' AND measure_code <> '05')""",
    "ratio_of_sums": """
        SELECT state_fips, year, sum(n_uninsured) / nullif(sum(sahie_total_population), 0) AS pct_uninsured
        FROM stg_sahie GROUP BY 1, 2""",
    "era_county_rates": f"""
        SELECT county_fips, era_name, {_share('sum(n_uninsured)', 'sum(sahie_total_population)')} AS pct_uninsured,
               {_share('sum(n_below_poverty)', 'sum(poverty_universe)')} AS poverty_rate,
               {_share('sum(unemployment_level)', 'sum(labor_force_level)')} AS unemployment_rate
        FROM fct JOIN dim_year USING (year) WHERE n_uninsured IS NOT NULL GROUP BY 1, 2""",
    "pivot_measures": """
        SELECT substr(series_id, 6, 5) AS place, year, period,
               max(value) FILTER (WHERE series_id LIKE '%03' AND length(series_id) = 12) AS unemployment_rate,
               max(value) FILTER (WHERE series_id LIKE '%04') AS unemployment_level,
               max(value) FILTER (WHERE series_id LIKE '%06') AS labor_force_level
        FROM bls_data GROUP BY 1, 2, 3""",
    "latest_per_key_window": "SELECT * FROM latest_ahrq",
    "latest_per_key_maxby": "SELECT * FROM latest_ahrq",
    "metric_by_dims": _metrics(WEIGHTED, ["era_name", "expansion_status"]),
    "metric_all_by_region": _metrics(list(METRICS), ["census_region"]),
    "metric_where": _metrics(list(METRICS), ["year"], "era_name = 'Trump1' AND census_region IN ('South', 'West')"),
    **{f"metric_{name}": _metrics([name], ["state_abbr", "year"]) for name in METRICS},
    "county_year_trends": "SELECT * FROM trends",
    "trend_by_era": _means("year, era_name"),
    "trend_by_expansion": _means("year, expansion_status"),
    "trend_by_both": _means("year, era_name, expansion_status", ", era_name || ' / ' || expansion_status AS \"group\""),
    "trend_all_groupings": _all_groupings(),
    "era_ordered": """
        SELECT year, era_name, round(avg(pct_uninsured) * 100, 6) AS pct_uninsured,
               CAST(CASE era_name WHEN 'Trump1' THEN 1 WHEN 'Biden' THEN 2 ELSE 3 END AS BIGINT) AS era_order
        FROM trends GROUP BY year, era_name""",
    "map_slice": """
        SELECT county_fips, county_name, state_abbr, pct_uninsured * 100 AS display_value, 'Trump1' AS era_label
        FROM trends WHERE year = 2020 AND pct_uninsured IS NOT NULL""",
    "map_slice_income": """
        SELECT county_fips, county_name, state_abbr, median_household_income AS display_value, 'Biden' AS era_label
        FROM trends WHERE year = 2021 AND median_household_income IS NOT NULL""",
    "available_years": "SELECT DISTINCT year FROM trends",
    "ext_expansion_exposure": """
        SELECT county_fips, year, expansion_status, expansion_year, year - expansion_year AS years_since_expansion,
               CASE WHEN expansion_year IS NULL THEN 'never' WHEN year < expansion_year THEN 'pre'
                    WHEN year <= expansion_year + 1 THEN 'adoption' ELSE 'post' END AS expansion_phase
        FROM fct JOIN dim_county USING (county_fips)""",
    "ext_era_expansion": _metrics(WEIGHTED[:4] + WEIGHTED[4:6], ["era_name", "expansion_status"]),
    "ext_diff_in_diff": _diff_in_diff(),
    "ext_county_series": "SELECT * FROM trends WHERE county_fips = '12003'",
    "ext_corr": """
        SELECT era_name, expansion_status, round(corr(unemployment_rate, pct_uninsured), 6) AS correlation,
               count(*) FILTER (WHERE unemployment_rate IS NOT NULL AND pct_uninsured IS NOT NULL) AS n_pairs
        FROM trends GROUP BY 1, 2""",
    "check_not_null": "SELECT * FROM dim_county WHERE is_expansion_state IS NULL",
    "check_unique": "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1",
    "check_accepted_values": """
        SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
        WHERE l_linestatus = 'F' AND l_returnflag NOT IN ('A', 'N')""",
    "check_relationships": """
        SELECT st, count(*) AS n_rows FROM places WHERE st NOT IN (SELECT state_fips FROM states) GROUP BY 1""",
    "check_between": """
        SELECT county_fips, year, poverty_rate FROM acs_raw WHERE poverty_rate < 0 OR poverty_rate > 0.25""",
    "check_ratio_bounds": """
        SELECT c_custkey, o_orderkey, o_totalprice, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice < 0 OR c_acctbal < 0 OR o_totalprice > c_acctbal""",
    "check_types": _check_types(),
    "quality_report": _quality_report(),
    "gen_ratio_of_sums": """
        SELECT l_linestatus, CAST(year(l_shipdate) AS BIGINT) AS year,
               sum(l_quantity) FILTER (WHERE l_returnflag = 'R') / nullif(sum(l_quantity), 0) AS return_ratio
        FROM lineitem GROUP BY 1, 2""",
    "gen_latest_per_key": """
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "gen_pivot_measures": """
        SELECT user_id, arg_min(value, event_id) FILTER (WHERE event_type = 'click') AS click,
               arg_min(value, event_id) FILTER (WHERE event_type = 'error') AS error,
               arg_min(value, event_id) FILTER (WHERE event_type = 'purchase') AS purchase,
               arg_min(value, event_id) FILTER (WHERE event_type = 'signup') AS signup,
               arg_min(value, event_id) FILTER (WHERE event_type = 'view') AS view
        FROM events GROUP BY 1""",
    "gen_range_lookup": _era_orders(0, 21, "era_name"),
    "gen_semi_join": """
        SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
    "gen_relationships": """
        SELECT l_orderkey, count(*) AS n_rows FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""",
    "gen_quality_report": _gen_quality_report(),
    "gen_fan_out_join": """
        SELECT o_orderkey AS orderkey, o_orderstatus, o_totalprice, l_linenumber, l_quantity
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "gen_interval_join": """
        SELECT o_orderkey, c_custkey, lo, hi FROM orders LEFT JOIN (
            SELECT c_custkey, c_custkey * 10 AS lo,
                   c_custkey * 10 + CASE WHEN c_custkey % 7919 = 0 THEN 3000000000 ELSE CAST(floor(c_acctbal / 100) AS BIGINT) END AS hi
            FROM customer) ON o_orderkey BETWEEN lo AND hi""",
    "gen_interval_widths": """
        WITH k AS (SELECT unnest([n_nationkey, n_nationkey + 25, n_nationkey + 50]) AS k FROM nation),
        r AS (SELECT k, more, CASE WHEN k = 62 THEN -5 ELSE (1::BIGINT << k) - 1 END AS lo
              FROM k, (VALUES (-1::BIGINT), (0::BIGINT), (1::BIGINT)) m(more) WHERE k <= 62)
        SELECT o_orderkey, v, k, more, lo, hi
        FROM (SELECT o_orderkey, (1::BIGINT << CAST(o_orderkey % 62 AS INT)) + o_orderkey // 62 % 11 - 5 AS v FROM orders)
        LEFT JOIN (SELECT *, lo + (1::BIGINT << k) + more AS hi FROM r) ON v BETWEEN lo AND hi""",
    "gen_interval_fractions": """
        SELECT o_orderkey, v, c_custkey, lo, hi FROM (SELECT o_orderkey, o_totalprice / 64 AS v FROM orders) LEFT JOIN (
            SELECT c_custkey, c_acctbal * 0.7::DOUBLE AS lo,
                   c_acctbal * 0.7::DOUBLE + pow(2::DOUBLE, -(c_custkey % 20)) * (1 + c_custkey % 3) AS hi FROM customer)
        ON v BETWEEN lo AND hi""",
    "gen_fan_out_hot": """
        SELECT o_orderkey AS orderkey, o_orderstatus, o_totalprice, l_linenumber, l_quantity
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "gen_spine_joins": """
        SELECT c_custkey, c_mktsegment, c_acctbal, n_orders, largest_order, n_events, largest_value FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS largest_order FROM orders GROUP BY 1)
            ON o_custkey = c_custkey
        LEFT JOIN (SELECT user_id, count(*) AS n_events, max(value) AS largest_value FROM events GROUP BY 1)
            ON user_id = c_custkey""",
    "gen_distinct": "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem",
    "gen_star_metrics": """
        SELECT r_name, year, sum(returned) / nullif(sum(quantity), 0) AS return_ratio,
               sum(returned) / nullif(sum(quantity), 0) * 100.0 AS returned_per_100,
               avg(quantity) AS avg_customer_quantity
        FROM quantities JOIN customer ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    **{name: f"SELECT * FROM {name}" for name in (
        "sahie_raw", "acs_raw", "bls_raw", "ahrq_raw", "stg_sahie", "stg_bls", "stg_acs", "stg_ahrq", "dim_county")},
}

STEPWISE = {
    "era_change_summary": _county_changes("era_name = 'Trump1'", "era_name = 'Biden'", ("trump1", "biden")),
    "ext_period_change": _county_changes("year = 2019", "year = 2022", ("before", "after")),
    "gen_period_change": """
        WITH rates AS (
            SELECT c_nationkey,
                   sum(returned) FILTER (WHERE year <= 1997) / nullif(sum(quantity) FILTER (WHERE year <= 1997), 0)
                       AS before_return_ratio,
                   sum(returned) FILTER (WHERE year >= 1999) / nullif(sum(quantity) FILTER (WHERE year >= 1999), 0)
                       AS after_return_ratio
            FROM quantities JOIN customer ON c_custkey = o_custkey GROUP BY 1
            HAVING count(*) FILTER (WHERE year <= 1997) > 0 AND count(*) FILTER (WHERE year >= 1999) > 0)
        SELECT c_nationkey, before_return_ratio, after_return_ratio,
               after_return_ratio - before_return_ratio AS change_return_ratio, n_name,
               CASE WHEN after_return_ratio - before_return_ratio > 0.01 THEN 'deteriorated'
                    WHEN after_return_ratio - before_return_ratio < -0.01 THEN 'improved' ELSE 'stable' END AS trajectory
        FROM rates JOIN nation ON c_nationkey = n_nationkey
        ORDER BY change_return_ratio DESC NULLS LAST, n_name LIMIT 10""",
}


def oracle_sql() -> dict[str, str]:
    expected = {name: with_relations(sql) for name, sql in EXPECTED.items()}
    return expected | {name: _nested(sql) for name, sql in STEPWISE.items()}
