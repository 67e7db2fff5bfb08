"""Materialise the panel: sources, staging views, dimension and fact tables, checks."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from countypanel import schemas
from countypanel.operators.quality import run_checks
from countypanel.plans import conform, contracts, raw, star
from countypanel.sources import reference_data
from countypanel.sources.delimited import ScanLog, read_padded_tsv
from countypanel.sources.json_matrix import read_row_lines
from countypanel.sources.tables import replace_partitions, replace_table, table_name, table_or_empty

Loader = Callable[[SparkSession], DataFrame | None]
PayloadReader = Callable[[SparkSession, str, Sequence[str], Sequence[int]], DataFrame]

#: Raw tables are stored by year: staging reads the years it wants, and a year can be replaced by itself.
BY_YEAR = ("year",)

RAW_TABLES = {
    "sahie": ("sahie_uninsured", schemas.RAW_SAHIE),
    "bls": ("bls_laus", schemas.RAW_BLS),
    "acs": ("acs_poverty", schemas.RAW_ACS),
    "ahrq": ("ahrq_clh", schemas.RAW_AHRQ),
}


class Loaders(dict[str, Loader]):
    """Loaders by source, and the log of the lines that their scans set aside."""

    def __init__(self, loaders: Mapping[str, Loader], log: ScanLog | None = None) -> None:
        super().__init__(loaders)
        self.log = log if log is not None else ScanLog()

    def __or__(self, other: Mapping[str, Loader]) -> Loaders:
        return Loaders({**self, **other}, self.log)


def file_loaders(landing: str, payloads: PayloadReader = read_row_lines, skip_unreadable: bool = False) -> Loaders:
    """Loaders over a landing folder with one subfolder per source; ``skip_unreadable`` leaves out health files that can't be read."""
    log = ScanLog()
    loaders: dict[str, Loader] = {
        "sahie": lambda s: raw.sahie_raw(
            payloads(s, f"{landing}/sahie", raw.SAHIE_COLUMNS, raw.SAHIE_YEARS)
        ),
        "bls": lambda s: raw.bls_raw(
            read_padded_tsv(s, f"{landing}/bls/la.series", log),
            read_padded_tsv(s, f"{landing}/bls/la.data.64.County", log),
        ),
        "acs": lambda s: raw.acs_raw(payloads(s, f"{landing}/acs", raw.ACS_COLUMNS, raw.ACS_YEARS)),
        "ahrq": lambda s: raw.load_ahrq(s, f"{landing}/ahrq", skip_unreadable, log),
    }
    return Loaders(loaders, log)


@dataclass
class LoadReport:
    """Rows written per source, and what went wrong with the others."""

    rows: dict[str, int] = field(default_factory=dict)
    errors: dict[str, Exception] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    #: Per source: years without files, files left out, anything else its loader warned of.
    incomplete: dict[str, list[str]] = field(default_factory=dict)
    #: Per source: malformed lines that were set aside, by what was read.
    malformed: dict[str, dict[str, int]] = field(default_factory=dict)


class SourceLoadError(RuntimeError):
    """Some sources failed; the others were written."""

    def __init__(self, report: LoadReport):
        self.report = report
        details = "; ".join(f"{key}: {error}" for key, error in report.errors.items())
        super().__init__(f"{len(report.errors)} source(s) failed: {details}")


def load_sources(
    spark: SparkSession,
    loaders: Mapping[str, Loader],
    only: Sequence[str] | None = None,
    skip: Sequence[str] = (),
    allow_fewer_years: bool = False,
    landed_years_only: bool = False,
) -> LoadReport:
    """Replace the raw table of every chosen source; one failing source does not stop the others.

    A loader that finds nothing to load returns None, and the table stays as it is. So it does, with an error, when the new rows
    lack years that the table has, unless ``allow_fewer_years``. With ``landed_years_only`` the years that landed are
    replaced and the table keeps its others. What loaders warn of and the malformed lines they set aside are in the report.
    """
    report = LoadReport()
    log = loaders.log if isinstance(loaders, Loaders) else ScanLog()
    for key, (name, schema) in RAW_TABLES.items():
        if only is not None and key not in only:
            continue
        if key in skip:
            report.skipped.append(key)
            continue
        with warnings.catch_warnings(record=True) as caught:
            warnings.simplefilter("always", UserWarning)
            try:
                df = loaders[key](spark)
                if df is None:
                    report.skipped.append(key)
                else:
                    df = schemas.assert_schema(df, schema, name)
                    if landed_years_only:
                        report.rows[key] = replace_partitions(df, name, "raw", BY_YEAR)
                    else:
                        report.rows[key] = replace_table(df, name, "raw", BY_YEAR, None if allow_fewer_years else _same_years)
                    if lines := log.take():
                        report.malformed[key] = lines
            except Exception as error:
                report.errors[key] = error
            log.forget()
        told = [w for w in caught if issubclass(w.category, UserWarning)]
        if told:
            report.incomplete[key] = [str(w.message) for w in told]
        for w in caught:
            warnings.warn_explicit(w.message, w.category, w.filename, w.lineno)
    if report.errors:
        raise SourceLoadError(report)
    return report


def _same_years(old: DataFrame, new: DataFrame) -> None:
    missing = old.select("year").distinct().join(new.select("year").distinct(), "year", "left_anti")
    years = sorted(row["year"] for row in missing.filter("year IS NOT NULL").collect())
    if years:
        raise ValueError(
            f"the new rows lack the years {years}, which the table has; allow_fewer_years replaces it all the same, landed_years_only keeps them"
        )


SEEDS = {
    "state_fips_lookup": (reference_data.states, schemas.SEED_STATES),
    "policy_eras": (reference_data.eras, schemas.SEED_ERAS),
    "medicaid_expansion_status": (reference_data.expansion, schemas.SEED_EXPANSION),
}


def load_seeds(spark: SparkSession, folder: str | None = None) -> dict[str, int]:
    """Write the lookup tables: from ``<name>.csv`` below a folder, or those shipped with the package."""
    return {
        name: replace_table(
            shipped(spark) if folder is None else reference_data.read_seed(spark, f"{folder}/{name}.csv", schema), name, "seeds"
        )
        for name, (shipped, schema) in SEEDS.items()
    }


def staging_views(spark: SparkSession) -> dict[str, DataFrame]:
    """The four staging plans over the raw tables, each also a temporary view."""
    ahrq = table_or_empty(spark, table_name("ahrq_clh", "raw"), schemas.RAW_AHRQ)
    views = {
        "stg_sahie": conform.stg_sahie(spark.table(table_name("sahie_uninsured", "raw"))),
        "stg_bls": conform.stg_bls(spark.table(table_name("bls_laus", "raw"))),
        "stg_acs": conform.stg_acs(spark.table(table_name("acs_poverty", "raw"))),
        "stg_ahrq": conform.stg_ahrq(ahrq),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def build_star(spark: SparkSession) -> dict[str, int]:
    """Write both dimensions and the fact, which is stored by year.

    Once written, the dimensions have a known size, so queries on the star join them by broadcast.
    """
    stg = staging_views(spark)
    states = spark.table(table_name("state_fips_lookup", "seeds"))
    expansion = spark.table(table_name("medicaid_expansion_status", "seeds"))
    eras = spark.table(table_name("policy_eras", "seeds"))
    return {
        "dim_county": replace_table(
            star.dim_county(stg["stg_sahie"], stg["stg_ahrq"], states, expansion), "dim_county", "dimensional"
        ),
        "dim_year": replace_table(star.dim_year(spark, eras), "dim_year", "dimensional"),
        "fct_county_year": replace_table(
            star.fact(stg["stg_sahie"], stg["stg_bls"], stg["stg_acs"], stg["stg_ahrq"]),
            "fct_county_year", "dimensional", ("year",),
        ),
    }


def panel_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """All checked tables by name."""
    tables = dict(staging_views(spark))
    for name in ("dim_county", "dim_year", "fct_county_year"):
        tables[name] = spark.table(table_name(name, "dimensional"))
    for name in ("state_fips_lookup", "policy_eras", "medicaid_expansion_status"):
        tables[name] = spark.table(table_name(name, "seeds"))
    return tables


class PanelCheckError(RuntimeError):
    """The panel was written, but some checks fail; ``report`` has a row per check."""

    def __init__(self, report: DataFrame, failing: list[Row]):
        self.report = report
        details = "; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failing_rows}" for r in failing)
        super().__init__(f"{len(failing)} check(s) failed: {details}")


def build_panel(
    spark: SparkSession,
    loaders: Mapping[str, Loader],
    only: Sequence[str] | None = None,
    skip: Sequence[str] = (),
    seeds: str | None = None,
    fail_on_checks: bool = True,
    allow_fewer_years: bool = False,
    landed_years_only: bool = False,
) -> DataFrame:
    """Sources, seeds, star schema; returns the quality report, or raises it if a check fails.

    The options of ``load_sources`` say what to do about years that have not landed; that files may be left out is an option of ``file_loaders``.
    Era names are checked against the seeds that the panel is built with.
    """
    load_sources(spark, loaders, only, skip, allow_fewer_years, landed_years_only)
    load_seeds(spark, seeds)
    build_star(spark)
    tables = panel_tables(spark)
    report = run_checks(tables, contracts.checks(contracts.era_names(tables["policy_eras"])))
    if fail_on_checks:
        lines = report.collect()  # one row per check
        report = spark.createDataFrame(lines, report.schema)
        failing = [line for line in lines if line.failing_rows]
        if failing:
            raise PanelCheckError(report, failing)
    return report
