"""A small hand-written panel with the edge rows of every source."""

from __future__ import annotations

from countypanel import schemas
from countypanel.plans import conform, star
from countypanel.sources import reference_data
from countypanel.sources.reference_data import local_table


def fill(schema, **values):
    return tuple(values.get(f.name) for f in schema)


def sahie(geoid, year, nui=10.0, nic=90.0, pct=10.0, name=None):
    return fill(schemas.RAW_SAHIE, geoid=geoid, name=name or f"County {geoid}", pctui_pt=pct, nui_pt=nui, nic_pt=nic, year=year)


def bls(fips, year, rate=5.0, level=5.0, force=100.0):
    return fill(
        schemas.RAW_BLS, county_fips=fips, state_fips=fips[:2], county_fips_within_state=fips[2:], year=year,
        unemployment_rate=rate, unemployment_level=level, labor_force_level=force,
    )


def acs(fips, year, poor=20.0, universe=100.0, **more):
    rate = poor / universe if poor is not None and universe else None
    base = dict(edu_universe=50.0, edu_hs_diploma=20.0, edu_bachelors=10.0, renters_total=40.0,
                renters_severe_burden=10.0, median_household_income=50000.0)
    return fill(
        schemas.RAW_ACS, county_fips=fips, state_fips=fips[:2], state=fips[:2], county=fips[2:], year=year,
        n_below_poverty=poor, poverty_universe=universe, poverty_rate=rate, **(base | more),
    )


def ahrq(fips, year, rucc=5.0, mds=3.0, people=1000.0, hpsa=1.0, trauma=12.0):
    return fill(
        schemas.RAW_AHRQ, county_fips=fips, year=year, rural_urban_code_2013=rucc, total_mds=mds,
        total_population=people, hpsa_primary_care=hpsa, dist_trauma_center_miles=trauma,
    )


class Panel:
    """Staging, dimensions and fact over literal raw rows."""

    def __init__(self, spark, sahie=(), bls=(), acs=(), ahrq=()):
        raw = {
            "sahie": local_table(spark, list(sahie), schemas.RAW_SAHIE),
            "bls": local_table(spark, list(bls), schemas.RAW_BLS),
            "acs": local_table(spark, list(acs), schemas.RAW_ACS),
            "ahrq": local_table(spark, list(ahrq), schemas.RAW_AHRQ),
        }
        self.stg_sahie = conform.stg_sahie(raw["sahie"])
        self.stg_bls = conform.stg_bls(raw["bls"])
        self.stg_acs = conform.stg_acs(raw["acs"])
        self.stg_ahrq = conform.stg_ahrq(raw["ahrq"])
        self.states = reference_data.states(spark)
        self.expansion = reference_data.expansion(spark)
        self.eras = reference_data.eras(spark)
        self.dim_county = star.dim_county(self.stg_sahie, self.stg_ahrq, self.states, self.expansion)
        self.dim_year = star.dim_year(spark, self.eras)
        self.fact = star.fact(self.stg_sahie, self.stg_bls, self.stg_acs, self.stg_ahrq)

    def tables(self):
        return {
            "stg_sahie": self.stg_sahie, "stg_bls": self.stg_bls, "stg_acs": self.stg_acs,
            "stg_ahrq": self.stg_ahrq, "dim_county": self.dim_county, "dim_year": self.dim_year,
            "fct_county_year": self.fact, "state_fips_lookup": self.states, "policy_eras": self.eras,
            "medicaid_expansion_status": self.expansion,
        }
