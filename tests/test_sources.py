import gzip
import json
import threading

import pytest
from pyspark.sql import functions as F

from countypanel import schemas
from countypanel.plans import raw
from countypanel.sources import delimited, headers, json_matrix, reference_data, tables
from tests.helpers import frame, values


def land(root, year, text):
    folder = root / f"year={year}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"reply{len(list(folder.iterdir()))}.json").write_text(text)


def reply(rows):
    return "[" + ",\n".join(json.dumps(r, ensure_ascii=False, separators=(",", ":")) for r in rows) + "]"


ROWS_2017 = [["GEOID", "NAME", "NUI_PT"], ["01001", 'Autauga "A", [AL]]', "5"], ["01003", None, "N/A"]]
ROWS_2018 = [["NAME", "GEOID", "EXTRA"], ["Doña Ana, NM],", "35013", "x"]]
EXPECTED = [
    ("01001", 'Autauga "A", [AL]]', "5", 2017),
    ("01003", None, "N/A", 2017),
    ("35013", "Doña Ana, NM],", None, 2018),
]


def test_row_lines_map_by_each_files_own_header(spark, tmp_path):
    land(tmp_path, 2017, reply(ROWS_2017))
    land(tmp_path, 2018, reply(ROWS_2018))
    df = json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID", "NAME", "NUI_PT"], [2017, 2018])
    assert values(df, "GEOID", "NAME", "NUI_PT", "year") == EXPECTED
    assert dict(df.dtypes)["year"] == "bigint"


def test_payload_lines_map_by_each_payloads_own_header(spark, tmp_path):
    land(tmp_path, 2017, json.dumps(ROWS_2017) + "\n")
    land(tmp_path, 2018, json.dumps(ROWS_2018, ensure_ascii=False) + "\n\n" + json.dumps([["GEOID"]]) + "\n")
    df = json_matrix.read_payload_lines(spark, str(tmp_path), ["GEOID", "NAME", "NUI_PT"], [2017, 2018])
    assert values(df, "GEOID", "NAME", "NUI_PT", "year") == EXPECTED


def test_row_lines_with_crlf_and_header_only_file(spark, tmp_path):
    land(tmp_path, 2017, reply(ROWS_2017).replace("\n", "\r\n"))
    land(tmp_path, 2018, '[["GEOID","NAME","NUI_PT"]]')
    df = json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID"], [2017, 2018])
    assert values(df, "GEOID") == [("01001",), ("01003",)]


def test_row_lines_refuse_a_payload_on_one_line(spark, tmp_path):
    land(tmp_path, 2017, json.dumps(ROWS_2017))
    with pytest.raises(ValueError, match="read_payload_lines"):
        json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID"], [2017])


def test_row_lines_refuse_a_second_header(spark, tmp_path):
    land(tmp_path, 2017, reply(ROWS_2017) + "\n" + reply(ROWS_2018))
    with pytest.raises(Exception, match="different headers"):
        json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID"], [2017]).collect()


def test_broken_row_fails_loudly(spark, tmp_path):
    land(tmp_path, 2017, '[["GEOID"],\n["01001",\n')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID"], [2017]).collect()


def test_missing_year_is_reported_and_no_year_fails(spark, tmp_path):
    land(tmp_path, 2017, reply(ROWS_2017))
    with pytest.warns(UserWarning, match="nothing landed for 2018"):
        df = json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID"], [2017, 2018])
    assert df.count() == 2
    with pytest.warns(UserWarning), pytest.raises(FileNotFoundError):
        json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID"], [2030])


def test_years_that_were_not_asked_for_are_not_read(spark, tmp_path):
    land(tmp_path, 2015, "this is no payload")
    land(tmp_path, 2017, reply(ROWS_2017))
    assert json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID"], [2017]).count() == 2


def test_padded_tsv(spark, tmp_path):
    (tmp_path / "la.series").write_text("series_id   \tarea_type_code\t value\nLAUCN1  \tF \t  01 \nLAUCN2\t\tx\n")
    df = delimited.read_padded_tsv(spark, str(tmp_path / "la.series"))
    assert df.columns == ["series_id", "area_type_code", "value"]
    assert values(df, "series_id", "area_type_code", "value") == [("LAUCN1", "F", "01"), ("LAUCN2", None, "x")]


def write_ahrq(folder):
    folder.mkdir()
    (folder / "clh_2017_county_1_0.csv").write_text(
        " FIPSCODE ,YEAR,ACS_PCT_UNINSURED,AHRF_TOT_MDS\n1001,2017.0,7.5,3\n,2017,1,1\n"
    )
    (folder / "clh_2018_county_1_0.csv").write_text("FIPSCODE,YEAR,ACS_PCT_UNINSURED,AHRF_TOT_MDS\n01003,2018,n/a,4\n")
    (folder / "clh_2019_county_2_0.csv").write_text(
        "COUNTYFIPS,YEAR,SAHIE_PCT_UNINSURED64,ACS_PCT_UNINSURED,AHRF_USDA_RUCC_2013\n01005,2019,8,99,6\n"
    )
    (folder / "other_2019.csv").write_text("COUNTYFIPS,YEAR\n99999,2019\n")


def test_drifting_csv_union(spark, tmp_path):
    folder = tmp_path / "ahrq"
    write_ahrq(folder)
    df = raw.load_ahrq(spark, str(folder))
    assert schemas.schema_drift(df, schemas.RAW_AHRQ) == []
    assert values(df, "county_fips", "year", "pct_uninsured_under65", "total_mds", "rural_urban_code_2013") == [
        ("01001", 2017, 7.5, 3.0, None),
        ("01003", 2018, None, 4.0, None),
        ("01005", 2019, 8.0, None, 6.0),
        (None, 2017, 1.0, 1.0, None),
    ]


def test_files_with_one_layout_share_a_scan(spark, tmp_path):
    folder = tmp_path / "ahrq"
    write_ahrq(folder)
    files = delimited.list_files(spark, str(folder), raw.AHRQ_FILES)
    assert len(files) == 3
    groups, unreadable = delimited.group_by_header(spark, files)
    assert sorted(len(g) for g in groups.values()) == [1, 2] and unreadable == []


def test_headers_of_a_thousand_files_take_one_job(spark, tmp_path):
    for i in range(1000):
        (tmp_path / f"part {i:04}.csv").write_text(f"\n k{i % 3} ,v\n1,2\n" if i else "")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write("k0,v\n1,2\n")
    files = delimited.list_files(spark, str(tmp_path))
    status, group = spark.sparkContext.statusTracker(), "headers of a thousand files"
    spark.sparkContext.setJobGroup(group, group)
    lines, errors = headers.first_lines(spark, [*files, "file:/no/such/file.csv"])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(status.getJobIdsForGroup(group)) == 1
    assert len(files) == 1001 and set(lines) == set(files) and list(errors) == ["file:/no/such/file.csv"]
    groups = headers.spread_files({f: line for f, line in lines.items() if line})
    assert {k: len(v) for k, v in groups.items()} == {("k0", "v"): 334, ("k1", "v"): 333, ("k2", "v"): 333}
    assert headers._by_scan(spark, files[:3] + files[-1:]) == {f: lines[f] for f in files[:3] + files[-1:] if lines[f]}
    assert headers.column_names('a, ,"b,c",A') == ("a0", "_c1", "b,c", "A3") and headers.column_names("") == ()


def test_malformed_lines_are_set_aside_and_counted(spark, tmp_path):
    path = tmp_path / "torn.tsv"
    path.write_text('a\t b\tc \n1\t2\t3\n1\t2\n1\t2\t3\t4\n\n"x\ty"\t"z"\t\n')
    log = delimited.ScanLog()
    df = delimited.read_padded_tsv(spark, str(path), log)
    assert values(df, "a", "b", "c") == sorted([("1", "2", "3"), ("x\ty", "z", None)], key=repr)
    assert log.take() == {str(path): 2} and log.take() == {}
    assert df.count() == 2 and df.select("b").filter("b = '2'").count() == 1
    assert sorted(r["line"] for r in delimited.malformed_tsv_lines(spark, str(path)).collect()) == ["1\t2", "1\t2\t3\t4"]


def test_unreadable_file_is_skipped_only_on_request(spark, tmp_path):
    folder = tmp_path / "ahrq"
    write_ahrq(folder)
    gone = f"file:{folder}/clh_2020_county.csv"
    files = delimited.list_files(spark, str(folder), raw.AHRQ_FILES) + [gone]
    with pytest.warns(UserWarning, match="skipped unreadable"):
        df = delimited.read_drifting_csv(spark, files, raw.AHRQ_ALIASES, skip_unreadable=True)
    assert df.count() == 4
    with pytest.raises(ValueError, match="clh_2020"):
        delimited.read_drifting_csv(spark, files, raw.AHRQ_ALIASES)


def test_no_known_column_yields_nothing(spark, tmp_path):
    (tmp_path / "clh_2017_county.csv").write_text("a,b\n1,2\n")
    with pytest.warns(UserWarning, match="no known column"):
        assert raw.load_ahrq(spark, str(tmp_path)) is None


def test_no_files_yield_nothing(spark, tmp_path):
    with pytest.warns(UserWarning, match="no usable"):
        assert raw.load_ahrq(spark, str(tmp_path / "nowhere")) is None
    assert delimited.list_files(spark, str(tmp_path / "nowhere")) == []


def test_seed_types_are_pinned(spark, tmp_path):
    (tmp_path / "seed.csv").write_text(
        "state_fips,state_name,state_abbr,expansion_status,expansion_year\n01,Alabama,AL,not_expanded,\n02,Alaska,AK,expanded,2015\n"
    )
    df = reference_data.read_seed(spark, str(tmp_path / "seed.csv"), schemas.SEED_EXPANSION)
    assert values(df, "state_fips", "expansion_year") == [("01", None), ("02", 2015)]


def test_shipped_seeds(spark):
    states, expansion = reference_data.states(spark), reference_data.expansion(spark)
    assert states.count() == expansion.count() == 51
    assert expansion.filter("expansion_status = 'expanded'").count() == 41
    assert states.select("census_region").distinct().count() == 4
    assert states.select("census_division").distinct().count() == 9
    assert schemas.schema_drift(reference_data.eras(spark), schemas.SEED_ERAS) == []


def test_replace_table_counts_and_replaces(spark):
    first = frame(spark, "k string, year long", ("a", 2017), ("b", 2018), ("c", 2018))
    assert tables.replace_table(first, "things", "testlayer", ("year",)) == 3
    assert tables.replace_table(first.filter("k = 'a'"), "things", "testlayer", ("year",)) == 1
    assert spark.table("testlayer.things").count() == 1
    assert tables.replace_table(first.select("year", "k"), "things", "testlayer") == 3
    assert spark.table("testlayer.things").columns == ["year", "k"]
    assert len(tables.versions(spark, "things", "testlayer")) == 2
    spark.sql("CREATE TABLE testlayer.plain USING parquet AS SELECT 1 AS k")  # as another program has left it
    assert tables.replace_table(first, "plain", "testlayer") == 3 and spark.table("testlayer.plain").count() == 3
    tables.drop_table(spark, "things", "testlayer")
    assert not spark.catalog.tableExists("testlayer.things") and not tables.versions(spark, "things", "testlayer")


def test_a_reader_finds_old_rows_or_new_ones_at_any_time(spark):
    old, new = spark.range(1000).withColumn("year", F.col("id") % 3), spark.range(1000, 3000).withColumn("year", F.col("id") % 4)
    tables.replace_table(old, "busy", "testlayer", ("year",))
    begun, seen, stop = spark.table("testlayer.busy"), [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.table("testlayer.busy").agg(F.count("id"), F.min("id")).first()[:])

    reader = threading.Thread(target=read)
    reader.start()
    try:
        tables.replace_table(new, "busy", "testlayer", ("year",))
    finally:
        stop.set()
        reader.join()
    seen.append(spark.table("testlayer.busy").agg(F.count("id"), F.min("id")).first()[:])
    assert set(seen) <= {(1000, 0), (2000, 1000)} and seen[-1] == (2000, 1000)
    assert begun.count() == 1000  # planned before, its version is still there


def test_a_break_at_any_step_loses_nothing(spark, monkeypatch):
    old, new = frame(spark, "k string, y string", ("1", "it's"), ("2", None)), frame(spark, "k string, y string", ("3", "a=b/c"))
    tables.replace_table(old, "torn", "testlayer", ("y",))
    whole = values(spark.table("testlayer.torn"), "k", "y")
    assert whole == [("1", "it's"), ("2", None)]
    steps = {(type(spark), "sql"), (type(old.write), "saveAsTable"), (type(old.write), "insertInto")}
    for at in range(1, 20):
        calls = iter(range(1, 100))

        def broken(f):
            def run(*args, **named):
                if next(calls) == at:
                    raise RuntimeError("catalog is away")
                return f(*args, **named)

            return run

        with monkeypatch.context() as patch:
            for owner, name in steps:
                patch.setattr(owner, name, broken(getattr(owner, name)))
            try:
                tables.replace_table(new, "torn", "testlayer", ("y",))
                done = True
            except RuntimeError:
                done = False
        now = values(spark.table("testlayer.torn"), "k", "y")
        assert now in ([("3", "a=b/c")], whole) and (now != whole or not done)
        tables.replace_table(old, "torn", "testlayer", ("y",))
        assert values(spark.table("testlayer.torn"), "k", "y") == whole and len(tables.versions(spark, "torn", "testlayer")) <= 2
        if done:
            break
    assert done and at > 5


def test_statements_do_not_grow_with_the_partitions(spark, monkeypatch):
    def statements(n):
        said = []
        with monkeypatch.context() as patch:
            sql = type(spark).sql
            patch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or sql(self, text, *a, **k))
            for _ in range(2):
                tables.replace_table(spark.range(n).withColumn("p", F.col("id")), f"parts{n}", "testlayer", ("p",))
        assert spark.table(f"testlayer.parts{n}").filter("p >= 0").count() == n
        return len(said)

    assert statements(500) == statements(3)


def test_landed_partitions_are_replaced_and_others_kept(spark):
    seven = frame(spark, "k string, year long", *[(f"old{y}", y) for y in range(2016, 2023)], ("none", None))
    assert tables.replace_partitions(seven, "years", "testlayer") == 8
    kept = {f for f in spark.table("testlayer.years").inputFiles() if "year=2017" not in f and "year=2020" not in f}
    landed = frame(spark, "year long, k string", (2017, "new2017"), (2020, "new2020"), (2030, "new2030"))
    assert tables.replace_partitions(landed, "years", "testlayer") == 3
    assert values(spark.table("testlayer.years"), "year", "k") == sorted(
        [(y, f"{'new' if y in (2017, 2020, 2030) else 'old'}{y}") for y in [*range(2016, 2023), 2030]] + [(None, "none")], key=repr)
    assert kept <= set(spark.table("testlayer.years").inputFiles())
    with pytest.raises(ValueError, match="has the columns"):
        tables.replace_partitions(landed.withColumn("more", F.lit(1)), "years", "testlayer")
    tables.replace_table(seven, "flat", "testlayer")
    with pytest.raises(ValueError, match="not stored by"):
        tables.replace_partitions(seven, "flat", "testlayer")


def test_writing_nothing_counts_nothing(spark):
    nothing = tables.empty_table(spark, schemas.RAW_AHRQ)
    assert tables.replace_table(nothing, "nothing", "testlayer") == 0
    assert tables.replace_table(nothing, "nothing", "testlayer", ("year",)) == 0
    assert spark.table("testlayer.nothing").count() == 0


def test_repeated_equal_headers_are_no_rows(spark, tmp_path):
    land(tmp_path, 2017, '[["GEOID"],\n["01001"],\n["01003"]]\n[["GEOID"],\n["01005"],\n]\n')
    df = json_matrix.read_row_lines(spark, str(tmp_path), ["GEOID"], [2017])
    assert values(df, "GEOID") == [("01001",), ("01003",), ("01005",)]


def test_failed_load_keeps_the_old_table(spark):
    good = frame(spark, "k string", ("1",))
    tables.replace_table(good, "kept", "testlayer")
    with pytest.raises(Exception):
        tables.replace_table(good.selectExpr("cast(k || 'x' as int) as k"), "kept", "testlayer")
    assert spark.table("testlayer.kept").count() == 1


def test_layer_names():
    assert tables.layer_name(" raw ") == "raw"
    assert tables.layer_name() == "main"
    assert tables.table_name("t", "staging") == "staging.t"


def test_optional_table(spark):
    df = tables.table_or_empty(spark, "testlayer.nowhere", schemas.RAW_AHRQ)
    assert df.count() == 0 and df.schema.names == schemas.RAW_AHRQ.names
