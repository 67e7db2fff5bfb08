"""Raw-source-shaped tables derived from the test tables ``orders`` and ``customer``.

A customer lives in state ``nationkey + 1`` and county ``custkey mod 1000``, all that the codes allow; an order counts for its year
moved 21 years on. Every measure is a count, hence exact in any order of summation.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countypanel import schemas
from countypanel.operators.reshape import resolve_aliases, union_all
from countypanel.plans import conform, raw, star
from countypanel.sources import reference_data
from countypanel.sources.tables import empty_table

YEAR_SHIFT = 21

AHRQ_COLUMNS_OLD = {
    "FIPSCODE": "county_fips", "YEAR": "year", "ACS_TOT_POP_WT": "total_population",
    "AHRF_TOT_MDS": "total_mds", "POS_MEDIAN_DIST_TRAUMA": "dist_trauma",
    "AHRF_USDA_RUCC_2013": "rucc", "AHRF_HPSA_PRIM": "hpsa", "ACS_PCT_UNINSURED": "pct_uninsured",
}
AHRQ_COLUMNS_NEW = {
    "COUNTYFIPS": "county_fips", "YEAR": "year", "ACS_TOT_POP_WT": "total_population",
    "AHRF_TOT_MDS": "total_mds", "POS_MEDIAN_DIST_TRAUMA": "dist_trauma",
    "POS_MEDIAN_DIST_OBSTETRICS": "dist_obstetrics", "AHRF_USDA_RUCC_2013": "rucc",
    "AHRF_HPSA_PRIM": "hpsa", "SAHIE_PCT_UNINSURED64": "pct_uninsured", "ACS_PCT_UNINSURED": "total_mds",
}
AHRQ_NEW_FROM = 2019


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one the session names, or a local one where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/countypanel-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="countypanel-")


class TestTables:
    """The test tables of one scale and everything derived from them.

    All frames are lazy, except that ``written`` stores the county-year counts once. Queries that use
    several sources then read the test tables once instead of once per source.
    """

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str, written: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir
        self.written = written

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def customer_years(self) -> DataFrame:
        """Order counts per customer and year; a customer with very many orders becomes a few rows here."""
        counts = {
            "n_all": "true",
            "n_f": "o_orderstatus = 'F'",
            "n_p": "o_orderstatus = 'P'",
            "n_p_low": "o_orderstatus = 'P' and o_orderpriority = '5-LOW'",
            "n_urgent": "o_orderpriority = '1-URGENT'",
            "n_high": "o_orderpriority = '2-HIGH'",
            "n_medium": "o_orderpriority = '3-MEDIUM'",
        }
        year = F.expr(f"cast(year(o_orderdate) + {YEAR_SHIFT} as bigint) as year")
        return (
            self.table("orders")
            .groupBy("o_custkey", year)
            .agg(*[F.expr(f"count_if({condition}) as {name}") for name, condition in counts.items()])
        )

    @cached_property
    def places(self) -> DataFrame:
        """State and county code of every customer."""
        return self.table("customer").selectExpr(
            "c_custkey",
            "lpad(cast(c_nationkey + 1 as string), 2, '0') as st",
            "lpad(cast(c_custkey % 1000 as string), 3, '0') as co",
        )

    @cached_property
    def counts(self) -> DataFrame:
        """Order counts per state, county and year, with the number of customers who ordered."""
        joined = self.customer_years.join(self.places, F.expr("o_custkey = c_custkey"))
        sums = [F.expr(f"sum({c}) as {c}") for c in self.customer_years.columns if c.startswith("n_")]
        counts = joined.groupBy("st", "co", "year").agg(F.expr("count(1) as customers"), *sums)
        if not self.written:
            return counts
        folder = scratch(self.spark)
        counts.write.parquet(folder)
        return self.spark.read.schema(counts.schema).parquet(folder)

    # --- landed shapes -----------------------------------------------------------------------------

    @cached_property
    def sahie_payload(self) -> DataFrame:
        """Insurance rows as the service sends them: all text, small counties suppressed."""
        return self.counts.selectExpr(
            "ltrim('0', st || co) as GEOID",
            "'County ' || st || co as NAME",
            "if(n_all >= 3, cast(n_f * 100 div n_all as string), 'N/A') as PCTUI_PT",
            "if(n_all >= 3, cast(n_f as string), 'N/A') as NUI_PT",
            "if(n_all >= 3, cast(n_all - n_f as string), 'N/A') as NIC_PT",
            "cast(year as string) as time",
            "'0' as AGECAT",
            "'0' as SEXCAT",
            "'0' as IPRCAT",
            "st as state",
            "co as county",
            "year",
        )

    @cached_property
    def sahie_categories(self) -> DataFrame:
        """Insurance rows of three age categories, of which only the first stands for everybody."""
        return self.sahie_payload.withColumn("AGECAT", F.expr("explode(array('0', '1', '2'))"))

    @cached_property
    def acs_payload(self) -> DataFrame:
        return self.counts.selectExpr(
            "'County ' || st || co as NAME",
            "case cast(co as int) % 7 when 0 then '-666666666' when 1 then 'NaN' when 2 then ' nan'"
            " else cast(30000 + 1000 * cast(co as int) + (year - 2016) as string) end as B19013_001E",
            "cast(n_urgent as string) as B17001_002E",
            "cast(n_all as string) as B17001_001E",
            "cast(n_all as string) as B15003_001E",
            "cast(n_high as string) as B15003_017E",
            "cast(n_medium as string) as B15003_022E",
            "cast(n_p as string) as B25070_001E",
            "cast(n_p_low as string) as B25070_010E",
            "st as state",
            "co as county",
            "year",
        )

    @cached_property
    def bls_series(self) -> DataFrame:
        """Series per place and measure; 05 is a measure nobody asked for."""
        places = self.places.select("st", "co").distinct()
        listed = places.selectExpr("*", "explode(array('03', '04', '05', '06')) as measure_code")
        return listed.selectExpr(
            "'LAUCN' || st || co || measure_code as series_id",
            "if(co = '000', 'A', 'F') as area_type_code",
            "'CN' || st || co || '00000000' as area_code",
            "measure_code",
        )

    @cached_property
    def bls_data(self) -> DataFrame:
        """Observations: an annual average and one month per series and year."""
        observed = {"03": "n_f * 100 div n_all", "04": "n_f", "05": "n_p", "06": "n_all"}
        rows = [
            f"struct('{measure}' as measure, '{period}' as period, cast({value} + {extra} as string) as value)"
            for measure, value in observed.items()
            for period, extra in (("M13", 0), ("M01", 7))
        ]
        return self.counts.selectExpr("st", "co", "year", f"inline(array({', '.join(rows)}))").selectExpr(
            "'LAUCN' || st || co || measure as series_id", "cast(year as string) as year", "period", "value"
        )

    @cached_property
    def ahrq_values(self) -> DataFrame:
        """Health measures as text."""
        return self.counts.selectExpr(
            "st || co as county_fips",
            "cast(year as int) as file_year",
            "year || '.0' as year",
            "cast(customers * 1000 as string) as total_population",
            "cast(n_all - n_f as string) as total_mds",
            "cast(1 + cast(co as int) % 10 as string) as rucc",
            "cast(cast(co as int) % 3 as string) as hpsa",
            "cast(5 * cast(co as int) as string) as dist_trauma",
            "cast(3 * cast(co as int) as string) as dist_obstetrics",
            "cast(n_f as string) as pct_uninsured",
        )

    def ahrq_layouts(self) -> list[DataFrame]:
        """The same measures in the two file layouts that followed each other."""
        old = self.ahrq_values.filter(F.col("file_year") < AHRQ_NEW_FROM)
        new = self.ahrq_values.filter(F.col("file_year") >= AHRQ_NEW_FROM)
        return [
            df.selectExpr("file_year", *[f"{c} as {name}" for name, c in columns.items()])
            for df, columns in ((old, AHRQ_COLUMNS_OLD), (new, AHRQ_COLUMNS_NEW))
        ]

    # --- the engine on top -------------------------------------------------------------------------

    @cached_property
    def sahie_raw(self) -> DataFrame:
        return raw.sahie_raw(self.sahie_payload)

    @cached_property
    def acs_raw(self) -> DataFrame:
        return raw.acs_raw(self.acs_payload)

    @cached_property
    def bls_raw(self) -> DataFrame:
        return raw.bls_raw(self.bls_series, self.bls_data)

    @cached_property
    def ahrq_raw(self) -> DataFrame:
        layouts = [resolve_aliases(df.drop("file_year"), raw.AHRQ_ALIASES) for df in self.ahrq_layouts()]
        return raw.ahrq_raw(union_all(layouts))

    @cached_property
    def states(self) -> DataFrame:
        return reference_data.states(self.spark)

    @cached_property
    def expansion(self) -> DataFrame:
        return reference_data.expansion(self.spark)

    @cached_property
    def eras(self) -> DataFrame:
        return reference_data.eras(self.spark)

    @cached_property
    def stg_sahie(self) -> DataFrame:
        return conform.stg_sahie(self.sahie_raw)

    @cached_property
    def stg_bls(self) -> DataFrame:
        return conform.stg_bls(self.bls_raw)

    @cached_property
    def stg_acs(self) -> DataFrame:
        return conform.stg_acs(self.acs_raw)

    @cached_property
    def stg_ahrq(self) -> DataFrame:
        return conform.stg_ahrq(self.ahrq_raw)

    @cached_property
    def dim_county(self) -> DataFrame:
        return star.dim_county(self.stg_sahie, self.stg_ahrq, self.states, self.expansion)

    @cached_property
    def dim_year(self) -> DataFrame:
        return star.dim_year(self.spark, self.eras)

    @cached_property
    def fact(self) -> DataFrame:
        """Health rows are used up to 2020, so that some county-years have none."""
        return star.fact(self.stg_sahie, self.stg_bls, self.stg_acs, self.stg_ahrq.filter("year <= 2020"))

    @cached_property
    def fact_without_ahrq(self) -> DataFrame:
        missing = conform.stg_ahrq(empty_table(self.spark, schemas.RAW_AHRQ))
        return star.fact(self.stg_sahie, self.stg_bls, self.stg_acs, missing)
