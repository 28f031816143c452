"""Code reference builds (P20): ICD-10-CM chapters and incident flags, deficiency tags,
measure intervals, billing-code and taxonomy crosswalks with their required members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import expr as X
from ..functions import predicates as P
from ..operators import aggs as A
from ..operators import contracts as C
from ..operators import joins as J
from ..operators import ranking as R
from ..operators import sets as S

# FIXED VALUES: substrings that find the columns of the code reference.
CCSR_CONTRACT = [
    C.Field("icd10_code", [["icd_10_cm", "code"], ["icd10", "code"]], match="substr", required=True,
            exclude=["description"]),
    C.Field("description", [["icd_10_cm", "description"], ["description"]], match="substr"),
    C.Field("default_ccsr_ip", [["default", "ip"]], match="substr"),
    C.Field("default_ccsr_op", [["default", "op"]], match="substr"),
    C.Field("body_system", [["body"]], match="substr"),
    *[f for n in range(1, 7) for f in (
        C.Field(f"ccsr_cat_{n}", [[f"category_{n}"]], match="substr", exclude=["description"]),
        C.Field(f"ccsr_cat_{n}_desc", [[f"category_{n}_description"]], match="substr"))],
]


def icd10_reference(raw: DataFrame, version: str = "") -> DataFrame:
    """ICD-10-CM codes (undotted and dotted, K8) with chapter and title by an ordered
    range ladder over the literal chapter table (E9), the incident flags (K24), body system,
    the six categories with their descriptions, and the file's version. Quotes around cells go.
    `raw` is the CSV read with `read_csv_with_preamble`, headers normalised (C6)."""
    d, _ = C.resolve_columns(C.normalize_headers(raw), CCSR_CONTRACT)
    d = d.select(*[F.btrim(F.regexp_replace(c, "^['\"]+|['\"]+$", "")).alias(c) for c in d.columns])
    d = d.withColumn("icd10_code", X.undot_code(F.regexp_replace("icd10_code", "['\"]", "")))
    d = d.withColumn("ccsr_version", F.lit(version))
    d = d.where(X.is_present("icd10_code"))
    ch = J.interval_label(X.category3("icd10_code"), K.ICD10_CHAPTERS, default="Unknown")
    chapter = F.when(F.length("icd10_code") < 3, F.lit("")).otherwise(ch["label"])
    title = F.when(ch["label"] == "Unknown", F.lit("")).otherwise(ch["extra_0"])
    return d.select("*", X.dot_code("icd10_code").alias("icd10_dotted"), chapter.alias("chapter"),
                    F.when(F.length("icd10_code") < 3, F.lit("")).otherwise(title).alias("chapter_title"),
                    *[v.alias(k) for k, v in X.prefix_flags("icd10_code").items()])


def icd10_subset(ref: DataFrame, prefixes: Sequence[str], negate: bool = False) -> DataFrame:
    """Codes starting with any prefix (or none of them)."""
    return P.where_prefix(ref, "icd10_code", list(prefixes), negate=negate)


def dominant_category(ref: DataFrame) -> DataFrame:
    """One row per 3-character category: the first code in code order."""
    return R.dedupe_keep(ref.withColumn("category3", X.category3("icd10_code")), "category3", ["icd10_code"])


def ftag_reference(pages: DataFrame) -> DataFrame:
    """Deficiency tag table from landed pages: prefix, number, composite tag (K7),
    description, category; last row per (prefix, number) wins (T19)."""
    contract = [C.Field("tag_prefix", [["prefix"]], match="substr", required=True),
                C.Field("tag_number", [["tag_number"], ["tag"]], match="substr", required=True,
                        exclude=["prefix", "description", "category"]),
                C.Field("description", [["description"]], match="substr"),
                C.Field("category", [["category"]], match="substr")]
    # the order of landed records: page file, then position in the page
    order = [c for c in ("_source_file", "_pos") if c in pages.columns]
    if not order:
        raise ValueError("landed pages carry _source_file and _pos; without them `last row` has no meaning")
    d, _ = C.resolve_columns(pages, contract + [C.Field(c, [c]) for c in order])
    d = d.withColumn("_seq", F.struct(*[F.col(c).cast("long") if c == "_pos" else F.col(c) for c in order])).drop(*order)
    d = d.withColumn("tag_prefix", X.clean("tag_prefix", case="upper")).withColumn("tag_number", X.clean("tag_number"))
    d = J.dedupe_last(d, ["tag_prefix", "tag_number"], "_seq").drop("_seq")
    return d.withColumn("prefix_tag", X.join_code("tag_prefix", "tag_number"))


def measure_intervals(raw: DataFrame) -> DataFrame:
    """Measure collection intervals: MM/DD/YYYY text -> dates, processing date YYYYMMDD."""
    def mdy(c):
        s = X.clean(c)
        return F.when(s.rlike(r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"), F.try_to_timestamp(s, F.lit("MM/dd/yyyy")).cast("date"))
    out = raw.withColumns({"collection_from_date": mdy("data_collection_period_from_date"),
                           "collection_through_date": mdy("data_collection_period_through_date")})
    if "processing_date" in raw.columns:
        s = X.clean("processing_date")
        out = out.withColumn("processing_dt", F.when(s.rlike(r"^[0-9]{8}$"),
                                                     F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("date")))
    return out


def crosswalk_members(crosswalk: DataFrame, col: str, required: Sequence[str]) -> DataFrame:
    """Required codes present in a crosswalk, and codes not in a reference list."""
    return S.required_members(crosswalk, col, list(required))


# FIXED VALUES: billing codes of nursing-facility visits, and taxonomy codes that the crosswalk must hold.
SNF_VISIT_CODES = ["99307", "99308", "99309", "99310"]
SNF_TAXONOMY = "314000000X"
GERIATRIC_TAXONOMY = ["207QG0300X", "207RG0300X"]


def _code_column(raw: DataFrame, *choices: list[str]) -> str:
    f = C.Field("code", list(choices), match="substr", required=True)
    found = C.find_column(raw.columns, f)
    if found is None:
        raise ValueError(f"no column named like {choices}; there are {sorted(raw.columns)}")
    return found


def rbcs_reference(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P20: the billing-code classification as landed, all columns, texts trimmed. Returns (table,
    required visit codes with their presence (I4), codes per category, most frequent first (F12))."""
    table = pages.select(*[F.btrim(F.col(f"`{c}`").cast("string")).alias(c) for c in pages.columns if not c.startswith("_")])
    code = _code_column(table, ["hcpcs"])
    category = _code_column(table, ["rbcs_cat"], ["category"])
    return table, S.required_members(table, code, SNF_VISIT_CODES), A.count_by(table, category)


def taxonomy_reference(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P20: the provider taxonomy crosswalk as landed, all columns, texts trimmed. Returns (table,
    required taxonomy codes with their presence (I4))."""
    table = pages.select(*[F.btrim(F.col(f"`{c}`").cast("string")).alias(c) for c in pages.columns if not c.startswith("_")])
    code = _code_column(table, ["taxonomy", "code"], ["taxonomy"])
    return table, S.required_members(table, code, [SNF_TAXONOMY, *GERIATRIC_TAXONOMY])
