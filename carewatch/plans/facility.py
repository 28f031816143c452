"""Enrollment union, owner flags, facility hub and exclusion tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expr as X
from ..operators import aggs as A
from ..operators import contracts as C
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import sets as S

# Output schema of the all-type enrollment table and the source spellings of each column (fixed values).
ENROLLMENT_SCHEMA = [("enrollment_id", "string"), ("npi", "string"), ("ccn", "string"),
                     ("org_name", "string"), ("dba_name", "string"), ("enrollment_state", "string"),
                     ("address_state", "string"), ("zip", "string"), ("provider_type_code", "string"),
                     ("provider_type_text", "string"), ("proprietary_nonprofit", "string"),
                     ("org_type_structure", "string")]
ENROLLMENT_RENAMES = {
    "enrollment_id": ["ENROLLMENT ID"], "npi": ["NPI"], "ccn": ["CCN"], "org_name": ["ORGANIZATION NAME"],
    "dba_name": ["DOING BUSINESS AS NAME"], "enrollment_state": ["ENROLLMENT STATE"], "address_state": ["STATE"],
    "zip": ["ZIP CODE"], "provider_type_code": ["PROVIDER TYPE CODE"], "provider_type_text": ["PROVIDER TYPE TEXT"],
    "proprietary_nonprofit": ["PROPRIETARY_NONPROFIT", "PROPRIETARY NONPROFIT"],
    "org_type_structure": ["ORGANIZATION TYPE STRUCTURE"],
}


def enrollments_all_types(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """P5: several provider-type enrollment files -> one labelled table.
    Each source may spell a column differently; the first present spelling wins."""
    renames = {label: ENROLLMENT_RENAMES for _, label in sources}
    return S.union_sources(sources, ENROLLMENT_SCHEMA, renames, label_col="provider_type_label")


def enrollment_counts(enroll: DataFrame) -> DataFrame:
    """Rows per provider type and state."""
    return A.count_by(enroll, ["provider_type_label", "address_state"], order=None)


def owner_flags(owners: DataFrame, flag_cols: Sequence[str] = K.OWNER_FLAG_COLS, seq: str | None = None
                ) -> DataFrame:
    """One row per enrollment: owner count, individual owners, 'any owner has flag Y'
    for each owner kind (F8), organisation name of the last record by `seq`. Headers are
    normalised (C6) in the output."""
    present = [c for c in flag_cols if c in owners.columns]
    o = owners.where(X.is_present("ENROLLMENT ID"))
    agg = A.any_flags(o, "ENROLLMENT ID", present, type_col="TYPE - OWNER",
                      name_col="ORGANIZATION NAME" if seq else None, seq=seq, suffix="")
    agg = agg.withColumnRenamed("last_ORGANIZATION NAME", "ORGANIZATION NAME").withColumnRenamed("n_rows", "owner_count").withColumnRenamed("n_individual", "individual_owner_count")
    return C.normalize_headers(agg)


def owners_public(flags: DataFrame, restricted: Sequence[str] = ()) -> DataFrame:
    """The facility aggregate for the public sink (B5): it holds the facility's organisation
    name and no name of a person; `restricted` columns are left out."""
    return flags.drop(*[c for c in restricted if c in flags.columns])


# Columns kept of the sources of the hub, and the names that some take in it (fixed values).
POS_KEEP = ["prvdr_num", "fac_name", "prvdr_type_id", "zip_cd", "state_cd", "fips_state_cd", "fips_cnty_cd", "cbsa_cd",
            "cbsa_urbn_rrl_ind", "orgnl_prtcptn_dt", "crtfctn_dt", "trmntn_exprtn_dt", "pgm_trmntn_cd", "fed_crtfctn_stus_name",
            "control_type", "gnrl_fac_type_cd", "bed_cnt", "crtfd_bed_cnt", "processing_date"]
POS_NAMES = {"fac_name": "pos_fac_name", "zip_cd": "pos_zip_cd", "state_cd": "pos_state_cd"}
DEMO_KEEP = ["zcta", "pct_white", "pct_black", "pct_asian", "pct_nhpi", "pct_hispanic", "non_hisp_white", "median_hh_income",
             "pct_disability", "acs_year"]
POP65_NAMES = {"Population_Total": "pop_total", "Population_65Plus": "pop_65plus"}


def hub_inputs(pos: DataFrame, owners: DataFrame | None, demographics: DataFrame | None, pop65: DataFrame | None):
    """The hub's sources under the names they have in it: kept columns only, and the owners'
    organisation name left to the spine's own (P7)."""
    def kept(df, names, renames=None):
        return None if df is None else df.select(*[F.col(c).alias((renames or {}).get(c, c)) for c in names if c in df.columns])
    return (kept(pos, POS_KEEP, POS_NAMES), None if owners is None else owners.drop("organization_name"),
            kept(demographics, DEMO_KEEP), kept(pop65, ["ZIP", *POP65_NAMES], POP65_NAMES))


def facility_master(enroll: DataFrame, pos: DataFrame | None, owners: DataFrame | None,
                    demographics: DataFrame | None, pop65: DataFrame | None, row_id: str | None = None,
                    expected: Mapping[str, tuple] | None = None) -> tuple[DataFrame, DataFrame]:
    """P7 hub: enrollment spine <- POS on padded CCN, <- owner flags on enrollment id,
    <- demographics on ZIP5, <- 65+ population on ZIP5 (optional sources are skipped,
    E4), all four in one exchange of the spine (`row_id`: see `build_hub`). Returns (master, checks):
    rows (check, value, ok) from one pass over the hub and one count of the spine, namely the spine
    count unchanged, the match rate of each source present with the POS and ZCTA floors (J13),
    and for each of `expected` = {name: (condition, least, most)} the rows that meet a condition."""
    spine = enroll.withColumns({"zip5": X.pad_key(X.zip5("zip"), 5), "npi_uri": X.uri(K.NPI_URI_BASE, "npi")})

    def source(name, df, key, ref_key, pad=None, optional=True):
        cols = [c for c in (df.columns if df is not None else []) if c != ref_key]
        return J.Source(name, df, key, ref_key, cols, f"{name}_matched", optional=optional, pad=pad)
    sources = [source("pos", pos, "ccn", "prvdr_num", 6, optional=False), source("owners", owners, "enrollment_id", "enrollment_id"),
               source("zcta", demographics, "zip5", "zcta", 5), source("pop65", pop65, "zip5", "ZIP", 5)]
    master = J.build_hub(spine, sources, row_id=row_id)
    floors = {"pos": ("match_rate", K.POS_MATCH_FLOOR), "owners": ("owners_match_rate", 0.0),
              "zcta": ("zcta_match_rate", K.ZCTA_MATCH_FLOOR), "pop65": ("pop65_match_rate", 0.0)}
    rates = {floors[s.name][0]: (s.flag, floors[s.name][1]) for s in sources if s.df is not None}
    return master, Q.hub_checks(enroll, master, rates, expected)


def exclusion_tiers(exclusions: DataFrame) -> dict[str, DataFrame]:
    """Exclusion list with severity tier (K11), individual vs entity and real-NPI
    tests (K32), and counts by tier / state / type (F1, H5)."""
    e = exclusions.select(
        "*", X.code_tier("EXCLTYPE").alias("severity_tier"),
        X.has_real_id("NPI").alias("npi_present"),
        (X.is_present("LASTNAME") & ~X.is_present("BUSNAME")).alias("is_individual"))
    return {"exclusions": e,
            "by_tier": A.count_by(e, "severity_tier"),
            "by_state": A.count_by(e, "STATE"),
            "npi_match_rate": A.match_rate(e, "npi_present")}
