import json
import shutil

import pytest
from pyspark.sql import functions as F

from countypanel import schemas
from countypanel.operators import quality
from countypanel.sources import json_matrix, tables
from countypanel.plans import analysis, build, metrics, raw
from countypanel.plans.contracts import CHECKS
from countypanel.sources.reference_data import local_table
from tests.helpers import frame, plan, values
from tests.panel_rows import Panel, acs, ahrq, bls, sahie


def report(df):
    return {(r["table_name"], r["check_name"], r["column_name"]): r["failing_rows"] for r in df.collect()}


def clean(spark, **replaced):
    rows = dict(
        sahie=[sahie("01001", 2017), sahie("02020", 2018)], bls=[bls("01001", 2017)], acs=[acs("01001", 2017)],
        ahrq=[ahrq("01001", 2017)],
    )
    return Panel(spark, **(rows | replaced))


def test_forty_checks():
    kinds = [c.kind for rules in CHECKS.values() for c in rules]
    counts = {k: kinds.count(k) for k in set(kinds)}
    assert counts == {
        "not_null": 22, "unique": 9, "accepted_values": 3, "relationships": 2, "between": 3, "part_of_whole": 1,
    }


def test_clean_panel_passes_everything(spark):
    got = report(quality.run_checks(clean(spark).tables(), CHECKS))
    assert len(got) == 40 and set(got.values()) == {0}


def test_panel_dirt_is_found(spark):
    dirty = clean(
        spark,
        sahie=[sahie("72001", 2017), sahie("01001", 2017, nui=-5.0, nic=2.0, pct=120.0), sahie("01001", 2017, name="Again")],
        bls=[bls("01001", 2017, rate=75.0)],
        acs=[acs("01001", 2017, poor=300.0)],
    )
    got = {k: v for k, v in report(quality.run_checks(dirty.tables(), CHECKS)).items() if v}
    assert got == {
        ("stg_sahie", "unique", "county_year_key"): 1,
        ("stg_sahie", "between", "pct_uninsured"): 1,
        ("stg_bls", "between", "unemployment_rate"): 1,
        ("stg_acs", "between", "poverty_rate"): 1,
        ("dim_county", "not_null", "is_expansion_state"): 1,
        ("dim_county", "unique", "county_fips"): 1,
        ("fct_county_year", "unique", "county_year_key"): 1,
        ("fct_county_year", "part_of_whole", "n_uninsured"): 1,
    }


def dirty_row(schema, **values_):
    return tuple(values_.get(f.name) for f in schema)


def test_every_check_fails_on_planted_dirt(spark):
    """A null, repeated, foreign or out-of-range value in every checked column."""
    tables = dict(clean(spark).tables())
    contracts = {
        "stg_sahie": schemas.STG_SAHIE, "stg_bls": schemas.STG_BLS, "stg_acs": schemas.STG_ACS,
        "dim_county": schemas.DIM_COUNTY, "dim_year": schemas.DIM_YEAR, "fct_county_year": schemas.FACT,
        "state_fips_lookup": schemas.SEED_STATES, "policy_eras": schemas.SEED_ERAS,
        "medicaid_expansion_status": schemas.SEED_EXPANSION,
    }
    wrong = dict(
        year=1900, pct_uninsured=7.0, unemployment_rate=99.0, poverty_rate=-1.0, era_name="Nobody",
        expansion_status="maybe", county_fips="99999", county_year_key="k", state_fips="99",
        n_uninsured=5.0, sahie_total_population=1.0,
    )
    for name, schema in contracts.items():
        rows = [dirty_row(schema), dirty_row(schema, **wrong), dirty_row(schema, **wrong)]
        tables[name] = tables[name].unionByName(local_table(spark, rows, schema))
    parents = {"dim_county": clean(spark).dim_county, "dim_year": clean(spark).dim_year}
    got = {}
    for name, rules in CHECKS.items():
        got |= report(quality.check_table(name, tables[name], rules, tables | parents))
    vacuous = {("stg_ahrq", "not_null", "county_fips")}
    assert {k for k, v in got.items() if v == 0} == vacuous
    assert got[("fct_county_year", "relationships", "county_fips")] == 2
    assert got[("stg_sahie", "unique", "county_year_key")] == 1


def test_single_checks_return_rows(spark):
    df = frame(spark, "k string, v double, w double", ("a", 1.0, 2.0), ("a", None, 2.0), (None, 9.0, 2.0), ("b", -1.0, 2.0))
    assert values(quality.not_null(df, "k"), "v") == [(9.0,)]
    assert values(quality.unique(df, "k"), "k", "n_rows") == [("a", 2)]
    assert values(quality.accepted_values(df, "k", ["a"]), "k") == [("b",)]
    assert values(quality.accepted_values(df, "k", ["a"], where="v > 0"), "k") == []
    assert values(quality.between(df, "v", 0, 5), "v") == [(-1.0,), (9.0,)]
    assert values(quality.part_of_whole(df, "v", "w"), "v") == [(-1.0,), (9.0,)]
    parent = frame(spark, "id string", ("a",))
    assert values(quality.relationships(df, "k", parent, "id"), "k", "n_rows") == [("b", 1)]


def test_all_checks_of_a_table_are_one_scan(spark, tmp_path):
    tables_ = clean(spark).tables()
    for name, df in tables_.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.parquet(str(tmp_path / name)) for name in tables_}
    text = plan(quality.check_table("stg_sahie", stored["stg_sahie"], CHECKS["stg_sahie"], {}))
    assert text.count("FileScan") == 1 and "Join" not in text.replace("BroadcastHashJoin", "").replace("joinType", "")
    every = quality.run_checks(stored, CHECKS)  # parents among them
    assert plan(every).count("FileScan") == len(stored) and len(report(every)) == 40
    assert "county_name" not in plan(every)


def test_declared_types(spark):
    df = frame(spark, "a string, b long", ("x", 1), ("y", 2))
    contract = schemas._schema("a string, b double, c long")
    assert schemas.check_types({"t": df}, {"t": df.schema}).count() == 0
    got = schemas.check_types({"t": df.withColumn("d", F.lit(1)), "u": df}, {"t": contract, "u": df.schema})
    assert values(got, "table_name", "column_name", "expected_type", "found_type", "n_rows") == sorted(
        [("t", "b", "double", "bigint", 2), ("t", "c", "bigint", None, 2), ("t", "d", None, "int", 2)], key=repr)


# --- build -----------------------------------------------------------------------------------------


def land(root):
    """Landed files of two counties as the services deliver them."""

    def reply(rows):
        return "[" + ",\n".join(json.dumps(r) for r in rows) + "]"

    for year in raw.SAHIE_YEARS:
        folder = root / "sahie" / f"year={year}"
        folder.mkdir(parents=True)
        rows = [["1001", "Autauga", "10", "10", "90", str(year), "0", "0", "0", "01", "001"],
                ["1000", "Alabama", "10", "10", "90", str(year), "0", "0", "0", "01", "000"]]
        (folder / "reply.json").write_text(reply([raw.SAHIE_COLUMNS, *rows]))
        folder = root / "acs" / f"year={year}"
        folder.mkdir(parents=True)
        rows = [["Autauga", "50000", "20", "100", "50", "20", "10", "40", "10", "1", "1"]]
        (folder / "reply.json").write_text(reply([raw.ACS_COLUMNS, *rows]))
    (root / "bls").mkdir()
    lines = ["series_id \tarea_type_code \tarea_code \tmeasure_code "]
    data = ["series_id \tyear\tperiod\tvalue "]
    for code, value in (("03", "5.0"), ("04", "5"), ("06", "100")):
        lines.append(f"L{code} \tF\tCN0100100000000\t{code}")
        data += [f"L{code} \t{year}\tM13\t {value}" for year in range(2016, 2025)]
    (root / "bls" / "la.series").write_text("\n".join(lines) + "\n")
    (root / "bls" / "la.data.64.County").write_text("\n".join(data) + "\n")
    (root / "ahrq").mkdir()
    (root / "ahrq" / "clh_2018_county_2_0.csv").write_text("COUNTYFIPS,YEAR,AHRF_TOT_MDS,AHRF_USDA_RUCC_2013\n1001,2018,3,2\n")


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    land(root)
    return str(root)


def drop_raw(spark):
    for name, _ in build.RAW_TABLES.values():
        tables.drop_table(spark, name, "raw")


def test_build_from_landed_files(spark, landing):
    got = report(build.build_panel(spark, build.file_loaders(landing)))
    assert len(got) == 40 and set(got.values()) == {0}
    fact = spark.table("dimensional.fct_county_year")
    assert values(fact, "county_fips", "year", "labor_force_level", "total_mds") == [
        ("01001", y, 100.0, 3.0 if y == 2018 else None) for y in range(2017, 2023)
    ]
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {tables.current_version(spark, 'fct_county_year', 'dimensional')}").collect()] == [
        f"year={y}" for y in range(2017, 2023)
    ]
    assert spark.table("stg_sahie").count() == 6
    one_year = fact.filter("year = 2019")
    assert "PartitionFilters: [isnotnull(year" in plan(one_year)
    county, year = spark.table("dimensional.dim_county"), spark.table("dimensional.dim_year")
    text = plan(analysis.era_change_summary(fact, county, year))
    assert "dynamicpruning" in text and "SortMergeJoin" not in text
    assert "dynamicpruning" in plan(
        metrics.metric(fact, ["weighted_avg_pct_uninsured"], ["census_region"], county, year, where={"era_name": "Biden"})
    )
    # a second build replaces everything
    assert build.build_star(spark)["fct_county_year"] == 6


def test_skip_and_only(spark, landing):
    drop_raw(spark)
    loaders = build.file_loaders(landing)
    done = build.load_sources(spark, loaders, only=["sahie", "bls"], skip=["bls"])
    assert done.rows == {"sahie": 14} and done.skipped == ["bls"]
    done = build.load_sources(spark, loaders, skip=["ahrq"])
    assert done.rows == {"sahie": 14, "bls": 9, "acs": 7}
    build.load_seeds(spark)
    assert build.build_star(spark) == {"dim_county": 1, "dim_year": 9, "fct_county_year": 6}
    assert spark.table("dimensional.fct_county_year").filter("total_mds is not null").count() == 0


def test_a_failing_source_does_not_stop_the_others(spark, landing):
    drop_raw(spark)
    loaders = build.file_loaders(landing) | {"bls": lambda s: s.read.csv("/no/such/file")}
    with pytest.raises(build.SourceLoadError) as caught:
        build.load_sources(spark, loaders)
    assert list(caught.value.report.errors) == ["bls"]
    assert set(caught.value.report.rows) == {"sahie", "acs", "ahrq"}


def test_a_source_with_no_files_keeps_its_table(spark, landing, tmp_path):
    build.load_sources(spark, build.file_loaders(landing), only=["ahrq"])
    with pytest.warns(UserWarning, match="no usable"):
        done = build.load_sources(spark, {"ahrq": lambda s: raw.load_ahrq(s, str(tmp_path / "none"))}, only=["ahrq"])
    assert done.skipped == ["ahrq"] and spark.table("raw.ahrq_clh").count() == 1


def test_missing_years_are_reported_and_not_lost(spark, landing, tmp_path):
    drop_raw(spark)
    loaders = build.file_loaders(landing)
    assert build.load_sources(spark, loaders, only=["acs"]).incomplete == {}
    fewer = {"acs": lambda s: raw.acs_raw(json_matrix.read_row_lines(s, f"{landing}/acs", raw.ACS_COLUMNS, [2018, 2030]))}
    with pytest.warns(UserWarning, match="nothing landed for 2030"), pytest.raises(build.SourceLoadError, match="lack the years") as caught:
        build.load_sources(spark, fewer, only=["acs"])
    assert "2030" in caught.value.report.incomplete["acs"][0]
    assert spark.table("raw.acs_poverty").select("year").distinct().count() == 7
    with pytest.warns(UserWarning):
        done = build.load_sources(spark, fewer, only=["acs"], allow_fewer_years=True)
    assert done.rows == {"acs": 1} and "2030" in done.incomplete["acs"][0]


def test_an_unreadable_health_file_is_an_error(spark, monkeypatch, landing):
    monkeypatch.setattr(raw, "list_files", lambda *a: [f"{landing}/ahrq/clh_2018_county_2_0.csv", f"{landing}/ahrq/clh_2020_county.csv"])
    build_error = pytest.raises(build.SourceLoadError, match="clh_2020")
    with build_error:
        build.load_sources(spark, build.file_loaders(landing), only=["ahrq"], allow_fewer_years=True)
    loaders = {"ahrq": lambda s: raw.load_ahrq(s, f"{landing}/ahrq", skip_unreadable=True)}
    with pytest.warns(UserWarning, match="skipped unreadable"):
        done = build.load_sources(spark, loaders, only=["ahrq"])
    assert done.rows == {"ahrq": 1} and "clh_2020" in done.incomplete["ahrq"][0]


def test_seeds_from_files_and_failing_checks(spark, landing, tmp_path):
    (tmp_path / "state_fips_lookup.csv").write_text("state_fips,state_name,state_abbr,census_region,census_division\n02,Alaska,AK,West,Pacific\n")
    (tmp_path / "policy_eras.csv").write_text("era_name,president,start_year,end_year,color_hex\nNew,Somebody,2016,2030,#000000\n")
    (tmp_path / "medicaid_expansion_status.csv").write_text("state_fips,state_name,state_abbr,expansion_status,expansion_year\n02,Alaska,AK,perhaps,2015\n")
    loaders = build.file_loaders(landing)
    with pytest.raises(build.PanelCheckError, match="medicaid_expansion_status.expansion_status accepted_values") as caught:
        build.build_panel(spark, loaders, seeds=str(tmp_path))
    failing = {(r.table_name, r.column_name) for r in caught.value.report.filter("failing_rows > 0").collect()}
    assert failing == {("medicaid_expansion_status", "expansion_status"), ("dim_county", "is_expansion_state")}
    assert {r.era_name for r in spark.table("dimensional.dim_year").collect()} == {"New"}  # and these are the accepted ones
    assert build.build_panel(spark, loaders, seeds=str(tmp_path), fail_on_checks=False).filter("failing_rows > 0").count() == 2
    spans = analysis.era_spans(spark.table("seeds.policy_eras"))
    assert spans == [("New", 2016, 2030)]
    assert spark.range(1).select(analysis.era_of_year(F.lit(2016), spans), analysis.era_of_year(F.lit(2015), spans)).first()[:] == ("New", "pre-era")


def test_build_options_reach_the_loaders(spark, landing, tmp_path):
    drop_raw(spark)
    build.build_panel(spark, build.file_loaders(landing), fail_on_checks=False)
    shutil.copytree(landing, tmp_path / "fewer")
    for source in ("sahie", "acs"):
        for year in (2016, 2019, 2022):
            shutil.rmtree(tmp_path / "fewer" / source / f"year={year}")
    (tmp_path / "fewer" / "ahrq" / "clh_2020_county_2_0.csv").write_text("")
    fewer = str(tmp_path / "fewer")
    with pytest.warns(UserWarning), pytest.raises(build.SourceLoadError, match="landed_years_only keeps them"):
        build.build_panel(spark, build.file_loaders(fewer, skip_unreadable=True), fail_on_checks=False)
    with pytest.raises(build.SourceLoadError, match="clh_2020"):
        build.build_panel(spark, build.file_loaders(fewer), only=["ahrq"], fail_on_checks=False)
    with pytest.warns(UserWarning):
        build.build_panel(spark, build.file_loaders(fewer, skip_unreadable=True), fail_on_checks=False, landed_years_only=True)
    assert spark.table("raw.sahie_uninsured").select("year").distinct().count() == 7
    with pytest.warns(UserWarning):
        build.build_panel(spark, build.file_loaders(fewer, skip_unreadable=True), fail_on_checks=False, allow_fewer_years=True)
    assert sorted(r.year for r in spark.table("raw.sahie_uninsured").select("year").distinct().collect()) == [2017, 2018, 2020, 2021]


def test_malformed_lines_are_in_the_report(spark, landing, tmp_path):
    shutil.copytree(landing, tmp_path / "torn")
    for file, lines in (("la.data.64.County", "LAUCN01\t2018\n\nLAUCN01\t2018\tM13\t5\tx\ty\tz\n"), ("la.series", "lonely\n")):
        path = tmp_path / "torn" / "bls" / file
        path.write_text(path.read_text() + lines)
    whole = build.load_sources(spark, build.file_loaders(landing), only=["bls"], allow_fewer_years=True)
    torn = build.load_sources(spark, build.file_loaders(str(tmp_path / "torn")), only=["bls"])
    assert whole.malformed == {} and torn.rows == whole.rows
    assert {k.rsplit("/", 1)[1]: n for k, n in torn.malformed["bls"].items()} == {"la.data.64.County": 2, "la.series": 1}


def test_a_source_that_breaks_its_contract_is_refused(spark, landing):
    loaders = {"sahie": lambda s: s.range(3)}
    with pytest.raises(build.SourceLoadError, match="sahie_uninsured: missing geoid"):
        build.load_sources(spark, loaders, only=["sahie"])
