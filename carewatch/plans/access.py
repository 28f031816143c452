"""Access analysis (P1-P4): providers per elderly resident by ZIP and by state.

Plan shape at scale: the provider extract (hundreds of millions of NPI rows in the
largest case) is filtered while it is scanned (active + 22 codes, compared trimmed and in
upper case, which Parquet cannot test itself), then ONE shuffle on (zip, state) aggregates it; census and military tables are ZIP-grained
context joined to the already-aggregated ZIP table; the state table is one more
shuffle on state; the rank uses the scalable cumulative-count plan (no single-partition
window).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expr as X
from ..functions import predicates as P
from ..operators import aggs as A
from ..operators import joins as J
from ..operators import ranking as R

SMALL_POP_THRESHOLD = 100


def ltpac_providers(npi: DataFrame, taxonomy: DataFrame | None = None,
                    codes=K.LTPAC_TAXONOMY_CODES) -> DataFrame:
    """Active providers in the code list, with the taxonomy lookup."""
    p = P.where_in(npi, "TaxonomyCode_1", codes, active=F.col("NPIDeactivationReasonCode").isNull())
    p = p.select("NPI", "EntityTypeCode", X.clean("TaxonomyCode_1", case="upper").alias("TaxonomyCode_1"),
                 X.clean("PracticeLocationState", case="upper").alias("State"),
                 X.zip5("PracticeLocationPostalCode").alias("PracticeZIP5"),
                 X.zip5("BusinessMailingPostalCode").alias("MailingZIP5"))
    if taxonomy is not None:
        t = taxonomy.select(X.clean("Code", case="upper").alias("TaxonomyCode_1"), "Classification",
                            "Specialization", F.col("DisplayName").alias("TaxonomyDisplayName"))
        p = J.lookup(p, t, "TaxonomyCode_1")
    return p


def providers_by_zip(providers: DataFrame, buckets=K.LTPAC_BUCKETS) -> DataFrame:
    """Per (ZIP, State): distinct NPIs, entity-type counts, category buckets (+ the
    'other' count the source omits, T14) and multi-location count (F2, F3, K33)."""
    p = P.where_present(providers, "PracticeZIP5")
    code = F.col("TaxonomyCode_1")
    b = {"facility_count": F.col("EntityTypeCode") == "2", "individual_count": F.col("EntityTypeCode") == "1"}
    b.update({name: code.isin(codes) for name, codes in buckets.items()})
    g = p.groupBy(F.col("PracticeZIP5").alias("ZIP"), "State").agg(
        F.count_distinct("NPI").alias("total_providers"),
        *[F.count_if(c).alias(n) for n, c in b.items()],
        F.count_if(~F.coalesce(code.isin([c for cs in buckets.values() for c in cs]), F.lit(False))).alias("other_count"),
        F.count_if(X.differs("MailingZIP5", "PracticeZIP5")).alias("multi_location_indicator"))
    return g


def access_analysis(by_zip: DataFrame, census: DataFrame, military: DataFrame,
                    small_threshold: int = SMALL_POP_THRESHOLD, as_of: dt.date | None = None) -> DataFrame:
    """ZIP table + census + military flag, rates per thousand elderly, small-denominator
    flag and precedence label (E2, K15, K22, K23, C8). Census and military are ZIP-keyed
    reference tables (tens of thousands of rows)."""
    c = census.select(F.col("ZIP"), F.col("Population_Total").cast("long").alias("population_total"),
                      F.col("Population_65Plus").cast("long").alias("population_65plus"),
                      F.col("ACS_Year").alias("acs_year"))
    e = J.enrich(by_zip, "ZIP", c, ["population_total", "population_65plus", "acs_year"],
                 flag_ref=military, flag_name="military_installation_flag", flag_key="ZIP")
    pop = F.col("population_65plus")
    out = e.select(
        "*",
        X.ratio("total_providers", "population_65plus", 1000, 2, guard=pop > 0).alias("providers_per_thousand_elderly"),
        X.ratio("facility_count", "population_65plus", 1000, 2, guard=pop > 0).alias("facilities_per_thousand_elderly"),
        X.ratio("population_65plus", "population_total", 100, 1, guard=F.col("population_total") > 0).alias("pct_65plus"),
        X.small_flag("population_65plus", small_threshold).cast("int").alias("small_denominator_flag"),
        X.reliability_label("ZIP", F.col("military_installation_flag") == 1, "population_65plus",
                            small_threshold).alias("zip_label"))
    if as_of is not None:
        out = out.withColumn("analysis_run_date", F.lit(str(as_of)).cast("date"))
    return out


def access_by_state(analysis: DataFrame) -> DataFrame:
    """State roll-up with population-weighted rates (F5, F6, D6) and ascending rank (G1).
    `military_zip_count` keeps the source's always-zero column (T13);
    `excluded_military_zips` is the real count, from the unfiltered input."""
    excluded = analysis.groupBy("State").agg(
        F.count_if(F.col("military_installation_flag") == 1).alias("excluded_military_zips"))
    r = P.where_rankable(analysis, "military_installation_flag", "population_65plus")
    s = r.groupBy("State").agg(
        F.count_distinct("ZIP").alias("zip_count"),
        F.sum("total_providers").alias("total_providers"),
        F.sum("facility_count").alias("total_facilities"),
        F.sum("individual_count").alias("total_individuals"),
        F.sum("population_total").alias("total_population"),
        F.sum("population_65plus").alias("total_pop_65plus"),
        F.round(A.rate_of_sums("total_providers", "population_65plus", 1000), 2).alias("providers_per_thousand_elderly"),
        F.round(A.rate_of_sums("facility_count", "population_65plus", 1000), 2).alias("facilities_per_thousand_elderly"),
        F.round(A.rate_of_sums("population_65plus", "population_total", 100), 1).alias("pct_65plus"),
        F.sum("small_denominator_flag").cast("long").alias("small_denominator_zip_count"),
        F.sum("military_installation_flag").cast("long").alias("military_zip_count"),
        F.max("acs_year").alias("acs_year"))
    s = s.join(excluded, "State", "left")
    return R.rank_by(s, "providers_per_thousand_elderly", asc=True, out="access_rank")


def census_65plus(rows: DataFrame, year_label: str, zcta_col: str = "zip code tabulation area") -> DataFrame:
    """Census 65+ pivot (P3): total and the sum of the twelve 65+ cells; suppressed
    counts become 0 like the source (T8) with a `suppressed_cells` count kept."""
    cells = K.CENSUS_65PLUS_CELLS
    parsed = [X.num(c, K.SENTINELS_CENSUS, on_missing=0, on_bad=0) for c in cells]
    return rows.select(
        F.col(f"`{zcta_col}`").alias("ZIP"),
        X.num(K.CENSUS_TOTAL_CELL, K.SENTINELS_CENSUS, on_missing=0, on_bad=0).cast("long").alias("Population_Total"),
        X.row_sum(parsed).cast("long").alias("Population_65Plus"),
        sum(X.is_sentinel(c).cast("int") for c in cells).alias("suppressed_cells"),
        F.lit(year_label).alias("ACS_Year"))


# FIXED VALUES: census variable -> output name, by table.
RACE_CELLS = {
    "B02001_001E": "race_total",
    "B02001_002E": "race_white",
    "B02001_003E": "race_black",
    "B02001_004E": "race_aian",
    "B02001_005E": "race_asian",
    "B02001_006E": "race_nhpi",
    "B02001_007E": "race_other",
    "B02001_008E": "race_multi",
}
RACE_PERCENTS = ("white", "black", "asian", "nhpi")
ORIGIN_CELLS = {
    "B03002_001E": "hispanic_total",
    "B03002_012E": "hispanic_count",
    "B03002_003E": "non_hisp_white",
}
INCOME_CELL = "B19013_001E"
DISABILITY_CELLS = {
    "S1811_C01_001E": "disability_pop_total",
    "S1811_C02_001E": "disability_count",
}
DISABILITY_PERCENT = "S1811_C03_001E"
# End of fixed values.


def _count(cell: str) -> Column:
    """A census count; suppressed is 0 like the source."""
    return X.num(cell, K.SENTINELS_CENSUS, on_missing=0, on_bad=0).cast("long")


def _percent(part: str, total: str) -> Column:
    return X.ratio(part, total, 100, 1, "half_even")


def census_race(rows: DataFrame, zcta_col: str = "zip code tabulation area") -> DataFrame:
    """P4 race table: counts, and percents of the total (NULL where the total is 0)."""
    d = rows.select(F.col(f"`{zcta_col}`").alias("zcta"), *[_count(c).alias(o) for c, o in RACE_CELLS.items()])
    return d.select("*", *[_percent(f"race_{r}", "race_total").alias(f"pct_{r}") for r in RACE_PERCENTS])


def census_origin(rows: DataFrame, zcta_col: str = "zip code tabulation area") -> DataFrame:
    """P4 Hispanic-origin table."""
    d = rows.select(F.col(f"`{zcta_col}`").alias("zcta"), *[_count(c).alias(o) for c, o in ORIGIN_CELLS.items()])
    return d.select("zcta", "hispanic_total", "hispanic_count",
                    _percent("hispanic_count", "hispanic_total").alias("pct_hispanic"), "non_hisp_white")


def census_income(rows: DataFrame, zcta_col: str = "zip code tabulation area") -> DataFrame:
    """P4 median household income; suppressed is NULL."""
    return rows.select(F.col(f"`{zcta_col}`").alias("zcta"),
                       X.num(INCOME_CELL, K.SENTINELS_CENSUS).cast("long").alias("median_hh_income"))


def census_disability(rows: DataFrame, zcta_col: str = "zip code tabulation area") -> DataFrame:
    """P4 disability table; the published percent, NULL where suppressed."""
    return rows.select(F.col(f"`{zcta_col}`").alias("zcta"), *[_count(c).alias(o) for c, o in DISABILITY_CELLS.items()],
                       X.round_to(X.num(DISABILITY_PERCENT, K.SENTINELS_CENSUS), 1, "half_even").alias("pct_disability"))


def census_demographics(tables: list[DataFrame], key: str = "zcta") -> DataFrame:
    """Merge several ZCTA-keyed census tables (P4): union of keys, every table's columns
    (E8) in one shuffle."""
    return J.outer_merge(tables, key)


def build(npi: DataFrame, taxonomy: DataFrame, census: DataFrame, military: DataFrame,
          small_threshold: int = SMALL_POP_THRESHOLD, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    providers = ltpac_providers(npi, taxonomy)
    by_zip = providers_by_zip(providers)
    analysis = access_analysis(by_zip, census, military, small_threshold, as_of)
    return {"providers": providers, "by_zip": by_zip, "analysis": analysis, "by_state": access_by_state(analysis)}
