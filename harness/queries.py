"""Every operator as a query over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel import schemas
from countypanel.functions import scalars as x
from countypanel.functions.ratios import ratio_of_sums, sum_when
from countypanel.operators import filters, joins, quality, reshape
from countypanel.plans import analysis, build, extensions, metrics, raw, star
from countypanel.plans.contracts import CHECKS
from countypanel.sources import delimited, json_matrix, reference_data, tables
from harness.adapter import YEAR_SHIFT, TestTables, scratch

Query = Callable[[SparkSession, str], DataFrame]
Builder = Callable[[TestTables], DataFrame]
BUILDERS: dict[str, Builder] = {}
REGISTRY: dict[str, Query] = {}

SAHIE_TEXT = [c.lower() for c in raw.SAHIE_COLUMNS] + ["year"]
MEASURES = analysis.TREND_MEASURES


def query(written: bool = False, name: str | None = None):
    """Register a function of the test tables under its own name or the given one."""

    def register(build: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(TestTables(spark, sf_dir, written))

        key = name or build.__name__
        BUILDERS[key], REGISTRY[key] = build, run
        return build

    return register


def order_year(shift: int = YEAR_SHIFT) -> Column:
    return F.expr(f"cast(year(o_orderdate) + {shift} as bigint)")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means and correlations depend on the order of summation in their last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources and sinks -----------------------------------------------------------------------------


@query()
def src_json_matrix(t: TestTables) -> DataFrame:
    """One payload per state and year, each a line; a payload holds at most the 1,000 county codes."""
    root = scratch(t.spark)
    row = F.to_json(F.array(*raw.SAHIE_COLUMNS))
    header = F.to_json(F.array(*[F.lit(c) for c in raw.SAHIE_COLUMNS]))
    payload = F.concat(F.lit("["), header, F.lit(","), F.array_join(F.collect_list(row), ","), F.lit("]"))
    t.sahie_payload.groupBy("year", "state").agg(payload.alias("value")).select("year", "value").write.partitionBy(
        "year"
    ).text(root)
    df = json_matrix.read_payload_lines(t.spark, root, raw.SAHIE_COLUMNS, raw.SAHIE_YEARS)
    return reshape.lower_names(df)


def _land_rows(payload: DataFrame, columns: Sequence[str], root: str) -> None:
    """A row per line; every state of a year opens with the header, so no task gathers a whole year."""
    group = ["year", "state"]
    header = F.concat(F.lit("["), F.to_json(F.array(*[F.lit(c) for c in columns])), F.lit(","))
    row = F.concat(F.to_json(F.array(*columns)), F.lit(","))
    rows = payload.select(*group, F.lit(1).alias("part"), row.alias("value"))
    groups = payload.select(*group).distinct()
    first = groups.select(*group, F.lit(0).alias("part"), header.alias("value"))
    last = groups.select(*group, F.lit(2).alias("part"), F.lit("]").alias("value"))
    lines = reshape.union_all([rows, first, last]).repartition(*group).sortWithinPartitions(*group, "part")
    lines.select("year", "value").write.partitionBy("year").text(root)


@query(written=True)
def src_json_matrix_rows(t: TestTables) -> DataFrame:
    root = scratch(t.spark)
    _land_rows(t.sahie_payload, raw.SAHIE_COLUMNS, root)
    df = json_matrix.read_row_lines(t.spark, root, raw.SAHIE_COLUMNS, raw.SAHIE_YEARS)
    return reshape.lower_names(df)


@query()
def src_category_filter(t: TestTables) -> DataFrame:
    return filters.all_people_rows(reshape.lower_names(t.sahie_categories))


def _land_padded(df: DataFrame, folder: str) -> None:
    padded = df.select(*[F.concat(F.lit("  "), F.col(c), F.lit("   ")).alias(f"{c}    ") for c in df.columns])
    writer = padded.write.option("sep", "\t").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)


@query()
def src_tsv_trim(t: TestTables) -> DataFrame:
    folder = scratch(t.spark)
    _land_padded(t.bls_data, folder)
    return delimited.read_padded_tsv(t.spark, folder).select("series_id", "year", "period", "value")


@query(written=True)
def src_tsv_malformed(t: TestTables) -> DataFrame:
    """Observations landed with short, long and quoted lines among them: what is read, and the lines set aside."""
    root, kind, tab = scratch(t.spark), F.col("value").cast("long") % 7, F.lit("\t")
    value = F.when(kind == 2, F.concat(F.lit('"'), "value", F.lit('"'))).when(kind == 3, F.concat(F.lit('"'), "value", F.lit('\tx"')))
    value = value.when(kind == 1, F.concat("value", F.lit("\textra"))).otherwise(F.col("value"))
    line = F.when(kind == 0, F.concat("series_id", tab, "year", tab, "period")).otherwise(F.concat("series_id", tab, "year", tab, "period", tab, value))
    rows = t.bls_data.select("year", F.lit(1).alias("part"), line.alias("value"))
    first = t.bls_data.select("year").distinct().withColumn("part", F.lit(0)).withColumn("value", F.lit("series_id\t year \tperiod\tvalue"))
    lines = rows.unionByName(first).repartition("year").sortWithinPartitions("year", "part")
    lines.select(F.col("year").alias("file_year"), "value").write.partitionBy("file_year").text(root)
    read = delimited.read_padded_tsv(t.spark, f"{root}/*/*").withColumn("line", F.lit(None).cast("string"))
    return read.unionByName(delimited.malformed_tsv_lines(t.spark, f"{root}/*/*"), allowMissingColumns=True)


@query(written=True)
def src_multi_schema_union(t: TestTables) -> DataFrame:
    root = scratch(t.spark)
    for version, layout in zip(("1_0", "2_0"), t.ahrq_layouts()):
        layout.write.partitionBy("file_year").option("header", True).csv(f"{root}/clh_all_county_{version}.csv")
    return raw.load_ahrq(t.spark, f"{root}/*/*")


def _own_table(name: str) -> str:
    """A table name that no other run uses."""
    return f"{name}_{uuid.uuid4().hex}"


@query()
def sink_rowcount(t: TestTables) -> DataFrame:
    """Store the whole raw insurance table and report the rows counted on the way."""
    n_rows = tables.replace_table(t.sahie_raw, _own_table("sahie"), "raw", ("year",))
    counted = F.lit(n_rows).cast("long").alias("n_rows")
    return t.spark.range(1).select(F.lit("sahie_uninsured").alias("table_name"), counted)


@query(written=True)
def sink_landed_years(t: TestTables) -> DataFrame:
    """Two years that land again, under other names, replace those of a table of seven."""
    name = _own_table("sahie")
    tables.replace_table(t.sahie_raw, name, "raw", ("year",))
    again = t.sahie_raw.filter(F.col("year").isin(2018, 2020)).withColumn("name", F.concat(F.lit("Again "), "name"))
    tables.replace_partitions(again, name, "raw", ("year",))
    return t.spark.table(tables.table_name(name, "raw"))


@query(written=True)
def panel_build(t: TestTables) -> DataFrame:
    """The fact that a whole build stores: sources landed as files, raw tables, seeds, star and checks."""
    landing = scratch(t.spark)
    _land_rows(t.sahie_payload, raw.SAHIE_COLUMNS, f"{landing}/sahie")
    _land_rows(t.acs_payload, raw.ACS_COLUMNS, f"{landing}/acs")
    _land_padded(t.bls_series, f"{landing}/bls/la.series")
    _land_padded(t.bls_data, f"{landing}/bls/la.data.64.County")
    for version, layout in zip(("1_0", "2_0"), t.ahrq_layouts()):
        files = layout.filter("file_year <= 2020").drop("file_year").write.option("header", True)
        files.csv(f"{landing}/ahrq/clh_2016_county_{version}.csv")
    build.build_panel(t.spark, build.file_loaders(landing), fail_on_checks=False, allow_fewer_years=True)
    return t.spark.table(tables.table_name("fct_county_year", "dimensional"))


@query(written=True)
def optional_source_empty(t: TestTables) -> DataFrame:
    return t.fact_without_ahrq


def _people_by_state(t: TestTables) -> DataFrame:
    return t.places.groupBy(F.col("st").alias("state_fips")).agg(F.count(F.lit(1)).alias("n_customers"))


def _with_people(t: TestTables, seed: DataFrame) -> DataFrame:
    people = joins.lookup(seed, _people_by_state(t), "state_fips")
    return people.withColumn("n_customers", F.coalesce("n_customers", F.lit(0)))


def _seed_from_csv(t: TestTables, seed: DataFrame) -> DataFrame:
    """A lookup table through the file form that users supply, blank where a year is missing."""
    folder = scratch(t.spark)
    seed.write.option("header", True).option("emptyValue", "").csv(folder)
    return reference_data.read_seed(t.spark, folder, seed.schema)


@query()
def seed_states(t: TestTables) -> DataFrame:
    return _with_people(t, _seed_from_csv(t, t.states))


@query()
def seed_expansion(t: TestTables) -> DataFrame:
    return _with_people(t, _seed_from_csv(t, t.expansion))


def _orders_by_year(t: TestTables) -> DataFrame:
    return t.table("orders").groupBy(order_year().alias("year")).agg(F.count(F.lit(1)).alias("n_orders"))


@query()
def seed_eras(t: TestTables) -> DataFrame:
    eras = _seed_from_csv(t, t.eras)
    dated = joins.range_lookup(_orders_by_year(t), F.col("year"), eras, "start_year", "end_year")
    counted = dated.groupBy("era_name").agg(F.sum("n_orders").alias("n_orders"))
    return eras.join(counted, "era_name", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


def _with_orders(t: TestTables, years: DataFrame) -> DataFrame:
    return years.join(_orders_by_year(t), "year", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query()
def gen_year_spine(t: TestTables) -> DataFrame:
    return _with_orders(t, star.year_spine(t.spark))


@query()
def dim_year(t: TestTables) -> DataFrame:
    return _with_orders(t, t.dim_year)


# --- raw tables, staging, star ---------------------------------------------------------------------

for _name in ("sahie_raw", "acs_raw", "stg_sahie", "stg_acs"):
    query(name=_name)(lambda t, name=_name: getattr(t, name))
for _name in ("bls_raw", "ahrq_raw", "stg_bls", "stg_ahrq", "dim_county"):
    query(written=True, name=_name)(lambda t, name=_name: getattr(t, name))
query(written=True, name="fct_county_year")(lambda t: t.fact)


@query(written=True)
def distinct_counties(t: TestTables) -> DataFrame:
    return star.distinct_counties(t.stg_sahie)


@query(written=True)
def star_join(t: TestTables) -> DataFrame:
    return star.star_join(t.fact, t.dim_county, t.dim_year).select(
        "county_fips", "year", "county_name", "state_abbr", "era_name", "n_uninsured", "labor_force_level"
    )


# --- scalar expressions ----------------------------------------------------------------------------


@query()
def fips_pad(t: TestTables) -> DataFrame:
    return t.table("customer").select(
        "c_custkey",
        x.fips_pad(F.col("c_custkey") * 100, 5).alias("county_fips"),
        x.fips_pad(F.col("c_nationkey") + 1, 2).alias("state_fips"),
    )


@query()
def zfill(t: TestTables) -> DataFrame:
    return t.table("orders").select("o_orderkey", x.zfill(F.col("o_orderkey") * 100, 5).alias("code"))


@query()
def fips_split(t: TestTables) -> DataFrame:
    area, fips = F.col("area_code"), F.concat(x.area_state(F.col("area_code")), x.area_county(F.col("area_code")))
    return t.bls_series.select(
        "series_id", x.area_state(area).alias("state_fips"), x.area_county(area).alias("county_code"),
        x.state_part(fips).alias("state_part"), x.county_part(fips).alias("county_part"),
    )


@query()
def fips_concat(t: TestTables) -> DataFrame:
    state, county = x.zfill(F.col("c_nationkey") + 1, 2), x.zfill(F.col("c_custkey"), 3)
    return t.table("customer").select("c_custkey", F.concat(state, county).alias("county_fips"))


@query()
def to_numeric(t: TestTables) -> DataFrame:
    columns = ("pctui_pt", "nui_pt", "nic_pt")
    return reshape.lower_names(t.sahie_payload).select(
        "geoid", "year", *[x.to_numeric(F.concat(F.lit(" "), F.col(c))).alias(c) for c in columns]
    )


@query()
def safe_cast(t: TestTables) -> DataFrame:
    return reshape.lower_names(t.sahie_payload).select(
        "geoid", "year", *[F.col(c).try_cast("double").alias(c) for c in ("pctui_pt", "nui_pt", "nic_pt")]
    )


@query()
def sentinel_null(t: TestTables) -> DataFrame:
    income = F.col("B19013_001E").cast("double")
    return t.acs_payload.select(
        "state", "county", "year", x.sentinel_to_null(income).alias("median_household_income")
    )


@query()
def neg_to_null(t: TestTables) -> DataFrame:
    return t.table("customer").select("c_custkey", x.negative_to_null(F.col("c_acctbal")).alias("c_acctbal"))


@query()
def acs_rates(t: TestTables) -> DataFrame:
    shares = ["poverty_rate", "pct_bachelors_plus", "pct_hs_plus", "pct_severe_rent_burden"]
    return t.acs_raw.select("county_fips", "year", *shares)


@query()
def rural_flag(t: TestTables) -> DataFrame:
    return t.table("part").select("p_partkey", x.rural_flag(F.col("p_size")).alias("is_rural"))


@query()
def expansion_flag(t: TestTables) -> DataFrame:
    people = t.places.select("c_custkey", F.col("st").alias("state_fips"))
    return joins.lookup(people, star.expansion_lookup(t.expansion), "state_fips")


@query()
def policy_event_label(t: TestTables) -> DataFrame:
    year = order_year(24)
    label = x.label_of(year, x.POLICY_EVENTS)
    return t.table("orders").select("o_orderkey", year.alias("year"), label.alias("policy_event_label"))


@query()
def trajectory_class(t: TestTables) -> DataFrame:
    change = F.col("l_discount") - F.col("l_tax")
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", change.alias("change"), x.trajectory_class(change).alias("trajectory")
    )


@query()
def era_of_year(t: TestTables) -> DataFrame:
    year = order_year(20)
    return t.table("orders").select("o_orderkey", year.alias("year"), analysis.era_of_year(year).alias("era"))


@query()
def surrogate_key(t: TestTables) -> DataFrame:
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber")
    return lines.withColumn("line_key", x.surrogate_key("l_orderkey", "l_linenumber"))


@query(written=True)
def to_pct(t: TestTables) -> DataFrame:
    return analysis.to_pct(_trends(t)).select("county_fips", "year", *MEASURES)


# --- filters, renames, unions ----------------------------------------------------------------------


@query()
def filter_year_window(t: TestTables) -> DataFrame:
    dated = t.table("orders").select("o_orderkey", order_year().alias("year"))
    return filters.year_window(dated, 2017, 2020)


@query()
def filter_aggregate_rows(t: TestTables) -> DataFrame:
    padded = reshape.lower_names(t.sahie_payload).select(
        x.fips_pad(F.col("geoid"), 5).alias("county_fips"), "name", "year"
    )
    return filters.drop_state_totals(padded)


@query()
def rename_map(t: TestTables) -> DataFrame:
    return reshape.lower_names(t.acs_payload.withColumnsRenamed(raw.ACS_VARIABLES))


@query(written=True)
def alias_resolve(t: TestTables) -> DataFrame:
    new = t.ahrq_layouts()[1].drop("file_year")
    return reshape.resolve_aliases(new, raw.AHRQ_ALIASES)


@query(written=True)
def union_by_name(t: TestTables) -> DataFrame:
    old, new = [df.drop("file_year") for df in t.ahrq_layouts()]
    return reshape.union_all([old, new])


# --- joins -----------------------------------------------------------------------------------------


@query()
def join_state_lookup(t: TestTables) -> DataFrame:
    people = t.places.select("c_custkey", F.col("st").alias("state_fips"))
    named = joins.lookup(people, t.states, "state_fips")
    return joins.lookup(named, star.expansion_lookup(t.expansion), "state_fips")


def _era_orders(t: TestTables, join: Callable[..., DataFrame]) -> DataFrame:
    dated = t.table("orders").select("o_orderkey", order_year().alias("year"))
    return join(dated, F.col("year"), t.eras, "start_year", "end_year").select(
        "o_orderkey", "year", "era_name", "president"
    )


@query()
def range_join_era(t: TestTables) -> DataFrame:
    return _era_orders(t, joins.range_lookup)


@query()
def range_join_exploded(t: TestTables) -> DataFrame:
    return _era_orders(t, joins.range_lookup)


@query(written=True)
def semi_join_series(t: TestTables) -> DataFrame:
    return joins.present_in(t.bls_data, raw.county_series(t.bls_series), "series_id")


# --- aggregates and windows ------------------------------------------------------------------------


@query(name="ratio_of_sums")
def ratio_of_sums_by_state(t: TestTables) -> DataFrame:
    ratio = ratio_of_sums(F.col("n_uninsured"), F.col("sahie_total_population"))
    return t.stg_sahie.groupBy("state_fips", "year").agg(ratio.alias("pct_uninsured"))


@query(written=True)
def era_county_rates(t: TestTables) -> DataFrame:
    dated = t.fact.filter(F.col("n_uninsured").isNotNull()).join(t.dim_year.select("year", "era_name"), "year")
    return dated.groupBy("county_fips", "era_name").agg(
        ratio_of_sums(F.col("n_uninsured"), F.col("sahie_total_population")).alias("pct_uninsured"),
        ratio_of_sums(F.col("n_below_poverty"), F.col("poverty_universe")).alias("poverty_rate"),
        ratio_of_sums(F.col("unemployment_level"), F.col("labor_force_level")).alias("unemployment_rate"),
    )


@query(written=True)
def pivot_measures(t: TestTables) -> DataFrame:
    """All periods and measures of the observations, one column per measure."""
    return reshape.pivot_measures(
        t.bls_data.withColumn("place", F.substring("series_id", 6, 5)).withColumn(
            "measure_code", F.substring("series_id", 11, 2)
        ),
        ["place", "year", "period"], "measure_code", "value", raw.BLS_MEASURES, "series_id",
    )


@query(written=True)
def latest_per_key_window(t: TestTables) -> DataFrame:
    return reshape.latest_per_key_window(t.stg_ahrq, ["county_fips"], ["year"])


@query(written=True)
def latest_per_key_maxby(t: TestTables) -> DataFrame:
    return reshape.latest_per_key(t.stg_ahrq, ["county_fips"], ["year"])


# --- metrics ---------------------------------------------------------------------------------------


@query(written=True)
def metric_by_dims(t: TestTables) -> DataFrame:
    names = [n for n in metrics.METRICS if n.startswith("weighted")]
    return metrics.metric(t.fact, names, ["era_name", "expansion_status"], t.dim_county, t.dim_year)


@query(written=True)
def metric_all_by_region(t: TestTables) -> DataFrame:
    return metrics.metric(t.fact, list(metrics.METRICS), ["census_region"], t.dim_county, t.dim_year)


@query(written=True)
def metric_where(t: TestTables) -> DataFrame:
    """A slice restricted on both dimensions and grouped by a column of the fact."""
    return metrics.metric(
        t.fact, list(metrics.METRICS), ["year"], t.dim_county, t.dim_year,
        where={"era_name": "Trump1", "census_region": ["South", "West"]},
    )


for _name in metrics.METRICS:
    query(written=True, name=f"metric_{_name}")(
        lambda t, name=_name: metrics.metric(t.fact, [name], ["state_abbr", "year"], t.dim_county, t.dim_year)
    )


# --- analyses --------------------------------------------------------------------------------------


def _trends(t: TestTables, ordered: bool = False) -> DataFrame:
    return analysis.county_year_trends(t.fact, t.dim_county, t.dim_year, ordered)


@query(written=True)
def era_change_summary(t: TestTables) -> DataFrame:
    return analysis.era_change_summary(t.fact, t.dim_county, t.dim_year)


@query(written=True)
def county_year_trends(t: TestTables) -> DataFrame:
    return _trends(t, ordered=True)


@query(written=True)
def trend_by_era(t: TestTables) -> DataFrame:
    return rounded(analysis.trend_by_era(_trends(t)), *MEASURES)


@query(written=True)
def trend_by_expansion(t: TestTables) -> DataFrame:
    return rounded(analysis.trend_by_expansion(_trends(t)), *MEASURES)


@query(written=True)
def trend_by_both(t: TestTables) -> DataFrame:
    return rounded(analysis.trend_by_both(_trends(t)), *MEASURES)


@query(written=True)
def trend_all_groupings(t: TestTables) -> DataFrame:
    return rounded(analysis.trend_all_groupings(_trends(t)), *MEASURES)


@query(written=True)
def era_ordered(t: TestTables) -> DataFrame:
    trend = analysis.trend_by_era(_trends(t), ["pct_uninsured"])
    return rounded(analysis.era_ordered(trend), "pct_uninsured")


@query(written=True)
def map_slice(t: TestTables) -> DataFrame:
    return analysis.map_slice(_trends(t), 2020, "pct_uninsured")


@query(written=True)
def map_slice_income(t: TestTables) -> DataFrame:
    """A measure that is no share keeps its unit."""
    return analysis.map_slice(_trends(t), 2021, "median_household_income")


@query(written=True)
def available_years(t: TestTables) -> DataFrame:
    return analysis.available_years(_trends(t))


@query(written=True)
def ext_expansion_exposure(t: TestTables) -> DataFrame:
    return extensions.expansion_exposure(t.fact, t.dim_county)


@query(written=True)
def ext_era_expansion(t: TestTables) -> DataFrame:
    return extensions.era_by_expansion(t.fact, t.dim_county, t.dim_year)


@query(written=True)
def ext_diff_in_diff(t: TestTables) -> DataFrame:
    return extensions.diff_in_diff(t.fact, t.dim_county, t.dim_year)


@query(written=True)
def ext_county_series(t: TestTables) -> DataFrame:
    return extensions.county_series(_trends(t), "12003")


@query(written=True)
def ext_corr(t: TestTables) -> DataFrame:
    return rounded(extensions.unemployment_correlation(_trends(t)), "correlation")


@query(written=True)
def ext_period_change(t: TestTables) -> DataFrame:
    return extensions.year_change(t.fact, t.dim_county, t.dim_year, 2019, 2022)


# --- data checks -----------------------------------------------------------------------------------


@query(written=True)
def check_not_null(t: TestTables) -> DataFrame:
    return quality.not_null(t.dim_county, "is_expansion_state")


@query()
def check_unique(t: TestTables) -> DataFrame:
    return quality.unique(t.table("orders"), "o_custkey")


@query()
def check_accepted_values(t: TestTables) -> DataFrame:
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return quality.accepted_values(lines, "l_returnflag", ["A", "N"], where="l_linestatus = 'F'")


@query()
def check_relationships(t: TestTables) -> DataFrame:
    return quality.relationships(t.places, "st", t.states, "state_fips")


@query()
def check_between(t: TestTables) -> DataFrame:
    return quality.between(t.acs_raw.select("county_fips", "year", "poverty_rate"), "poverty_rate", 0, 0.25)


@query()
def check_ratio_bounds(t: TestTables) -> DataFrame:
    """Order totals that exceed the customer's balance, or a negative balance."""
    orders = t.table("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    balances = t.table("customer").select("c_custkey", "c_acctbal")
    return quality.part_of_whole(orders.join(balances, "c_custkey"), "o_totalprice", "c_acctbal")


@query(written=True)
def quality_report(t: TestTables) -> DataFrame:
    def stored(df: DataFrame) -> DataFrame:
        """Tables that are costly to derive are checked in stored form, since several checks read them."""
        folder = scratch(t.spark)
        tables.write_files(df, folder)
        return t.spark.read.schema(df.schema).parquet(folder)

    stg_bls = stored(t.stg_bls)
    fact = star.fact(t.stg_sahie, stg_bls, t.stg_acs, t.stg_ahrq.filter("year <= 2020"))
    checked = {
        "stg_sahie": t.stg_sahie, "stg_bls": stg_bls, "stg_acs": t.stg_acs, "stg_ahrq": t.stg_ahrq,
        "dim_county": stored(t.dim_county), "dim_year": t.dim_year, "fct_county_year": stored(fact),
        "state_fips_lookup": t.states, "policy_eras": t.eras, "medicaid_expansion_status": t.expansion,
    }
    return quality.run_checks(checked, CHECKS)


@query()
def check_types(t: TestTables) -> DataFrame:
    """Columns of the stored tables that break a contract with wrong types, a column too many and one too few."""
    declared = {
        "orders": "o_orderkey long, o_custkey string, o_orderstatus string, o_totalprice double, o_orderpriority string, o_comment string",
        "nation": "n_nationkey long, n_name string, n_regionkey long",
        "events": "event_id long, ts string, user_id long, event_type string, value double, props string",
        "customer": "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string",
    }
    contracts = {name: schemas._schema(columns) for name, columns in declared.items()}
    return schemas.check_types({name: t.table(name) for name in contracts}, contracts)


# --- the same operators on the larger tables -------------------------------------------------------


def _returned() -> Column:
    return F.col("l_returnflag") == "R"


@query()
def gen_ratio_of_sums(t: TestTables) -> DataFrame:
    returned = F.when(_returned(), F.col("l_quantity"))
    return t.table("lineitem").groupBy("l_linestatus", F.year("l_shipdate").cast("long").alias("year")).agg(
        ratio_of_sums(returned, F.col("l_quantity")).alias("return_ratio")
    )


@query()
def gen_latest_per_key(t: TestTables) -> DataFrame:
    return reshape.latest_per_key(t.table("events"), ["user_id"], ["ts", "event_id"])


@query()
def gen_pivot_measures(t: TestTables) -> DataFrame:
    kinds = {k: k for k in ("click", "error", "purchase", "signup", "view")}
    return reshape.pivot_measures(t.table("events"), ["user_id"], "event_type", "value", kinds, "event_id")


@query()
def gen_range_lookup(t: TestTables) -> DataFrame:
    """Every order with the era its year falls into, the eras moved to the years of the orders."""
    eras = t.eras.select(
        "era_name",
        (F.col("start_year") - YEAR_SHIFT).alias("start_year"),
        (F.col("end_year") - YEAR_SHIFT).alias("end_year"),
    )
    dated = t.table("orders").select("o_orderkey", order_year(0).alias("year"))
    return joins.range_lookup(dated, F.col("year"), eras, "start_year", "end_year").select(
        "o_orderkey", "year", "era_name"
    )


@query()
def gen_semi_join(t: TestTables) -> DataFrame:
    builders = t.table("customer").filter("c_mktsegment = 'BUILDING'")
    orders = t.table("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return joins.present_in(orders, builders, "c_custkey")


@query()
def gen_relationships(t: TestTables) -> DataFrame:
    """Order keys of line items whose order is missing or not yet finished."""
    finished = t.table("orders").filter("o_orderstatus = 'F'")
    return quality.relationships(t.table("lineitem"), "l_orderkey", finished, "o_orderkey")


GEN_CHECKS = {
    "orders": [
        quality.Check("not_null", "o_custkey"),
        quality.Check("unique", "o_orderkey"),
        quality.Check("accepted_values", "o_orderstatus", values=("F", "O")),
        quality.Check("between", "o_totalprice", low=1000, high=400000, where="o_orderstatus = 'F'"),
        quality.Check("relationships", "o_custkey", parent="customer", parent_column="c_custkey"),
    ],
    "lineitem": [
        quality.Check("not_null", "l_shipdate"),
        quality.Check("between", "l_discount", low=0, high=0.05),
        quality.Check("part_of_whole", "l_tax", parent_column="l_discount"),
        quality.Check("relationships", "l_partkey", parent="part", parent_column="p_partkey"),
        quality.Check("unique", "l_orderkey"),
    ],
    "customer": [quality.Check("unique", "c_custkey"), quality.Check("between", "c_acctbal", low=0, high=9000)],
}


@query()
def gen_quality_report(t: TestTables) -> DataFrame:
    return quality.run_checks({name: t.table(name) for name in (*GEN_CHECKS, "part")}, GEN_CHECKS)


@query()
def gen_fan_out_join(t: TestTables) -> DataFrame:
    """Every order with its lines; some orders have none, most a few."""
    orders = t.table("orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus", "o_totalprice")
    lines = t.table("lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    return joins.fan_out_left_join(orders, lines, ["orderkey"])


@query()
def gen_interval_join(t: TestTables) -> DataFrame:
    """Orders in the key ranges of customers: nested ranges, empty ones, ranges of one key, some three billion keys wide."""
    start = F.col("c_custkey") * 10
    width = F.when(F.col("c_custkey") % 7919 == 0, F.lit(3_000_000_000)).otherwise(F.floor(F.col("c_acctbal") / 100))
    ranges = t.table("customer").select("c_custkey", start.alias("lo"), (start + width).alias("hi"))
    orders = t.table("orders").select("o_orderkey")
    return joins.range_lookup(orders, F.col("o_orderkey"), ranges, "lo", "hi").select("o_orderkey", "c_custkey", "lo", "hi")


@query()
def gen_interval_widths(t: TestTables) -> DataFrame:
    """Orders spread around the powers of two, in ranges one short of, equal to and one above a power of two long."""
    power = F.expr("shiftleft(1L, cast(o_orderkey % 62 as int))")
    orders = t.table("orders").select("o_orderkey", (power + F.expr("o_orderkey div 62 % 11 - 5")).alias("v"))
    ranges = t.table("nation").selectExpr(
        "explode(filter(array(n_nationkey, n_nationkey + 25, n_nationkey + 50), k -> k <= 62)) as k"
    ).selectExpr("k", "explode(array(-1L, 0L, 1L)) as more")
    ranges = ranges.selectExpr("k", "more", "if(k = 62, -5L, shiftleft(1L, k) - 1) as lo").selectExpr("*", "lo + shiftleft(1L, k) + more as hi")
    return joins.range_lookup(orders, F.col("v"), ranges, "lo", "hi")


@query()
def gen_interval_fractions(t: TestTables) -> DataFrame:
    """Order totals in ranges whose bounds and widths are fractions."""
    lo, width = F.col("c_acctbal") * 0.7, F.expr("pow(2D, -(c_custkey % 20)) * (1 + c_custkey % 3)")
    ranges = t.table("customer").select("c_custkey", lo.alias("lo"), (lo + width).alias("hi"))
    orders = t.table("orders").select("o_orderkey", (F.col("o_totalprice") / 64).alias("v"))
    return joins.range_lookup(orders, F.col("v"), ranges, "lo", "hi")


@query()
def gen_fan_out_hot(t: TestTables) -> DataFrame:
    """Every order with its lines, those of over three lines spread over several tasks."""
    orders = t.table("orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus", "o_totalprice")
    lines = t.table("lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    return joins.fan_out_left_join(orders, lines, ["orderkey"], rows_per_task=3)


@query()
def gen_spine_joins(t: TestTables) -> DataFrame:
    """Measures of three sources side by side on the key of the leading one, each reduced to that key."""
    key = "c_custkey"
    bought = t.table("orders").groupBy(F.col("o_custkey").alias(key)).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("largest_order")
    )
    seen = t.table("events").groupBy(F.col("user_id").alias(key)).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("largest_value")
    )
    spine = t.table("customer").select(key, "c_mktsegment", "c_acctbal")
    return spine.join(bought, key, "left").join(seen, key, "left")


@query()
def gen_distinct(t: TestTables) -> DataFrame:
    return t.table("lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


def _quantities(t: TestTables) -> DataFrame:
    """Quantity and returned quantity per customer and year of order.

    Line items are summed per order before the join, and orders per customer after it, so neither a large
    order nor a busy customer travels as many rows.
    """
    per_order = t.table("lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"),
        sum_when(_returned(), F.col("l_quantity")).alias("returned"),
    )
    orders = t.table("orders").select("o_orderkey", "o_custkey", order_year(0).alias("year"))
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_custkey", "year").agg(
        F.sum("quantity").alias("quantity"), F.sum("returned").alias("returned")
    )


@query()
def gen_period_change(t: TestTables) -> DataFrame:
    homes = t.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    placed = _quantities(t).join(homes, "o_custkey")
    early, late = F.col("year") <= 1997, F.col("year") >= 1999
    changes = analysis.period_change(placed, "c_nationkey", early, late, {"return_ratio": ("returned", "quantity")})
    nations = t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    named = changes.join(nations, "c_nationkey").withColumn(
        "trajectory", x.trajectory_class(F.col("change_return_ratio"))
    )
    return analysis.largest_changes(named, "change_return_ratio", "n_name", 10)


@query()
def gen_star_metrics(t: TestTables) -> DataFrame:
    nations = t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    regions = t.table("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    homes = t.table("customer").join(nations, "c_nationkey").join(regions, "n_regionkey")
    place = homes.select(F.col("c_custkey").alias("o_custkey"), "n_name", "r_name", "c_mktsegment")
    wanted = [
        metrics.Metric("return_ratio", "returned", "quantity"),
        metrics.Metric("returned_per_100", "returned", "quantity", 100.0),
        metrics.Metric("avg_customer_quantity", "quantity"),
    ]
    return metrics.evaluate(_quantities(t), wanted, ["r_name", "year"], [metrics.Dimension(place, "o_custkey")])
