"""Conformance run (P22) and universe / published-figure reconciliation.

P22 scans every registered output ONCE: one wide aggregate per dataset gives the column
profile, from which null-rate, constant-value and type findings are derived; schema
diffs, suppressions, severity tiers, drift against the previous snapshot and
cross-source row-count pairs are joins of small tables. The result is three DataFrames
(findings, summary, snapshot) ready for the B7 sinks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import quality as Q
from ..sources.readers import literal_table


def registry_frame(spark: SparkSession, registry: Sequence[Mapping]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Registry entries -> (datasets, known anomalies, published finding fields).
    Entry keys: name, fields_computed [..], known_anomalies [{field, check, reason}],
    finding_fields [..]."""
    ds = literal_table(spark, [(r["name"],) for r in registry], "dataset string")
    known = literal_table(
        spark, [(r["name"], a["field"], a["check"], a.get("reason", "")) for r in registry
         for a in r.get("known_anomalies", [])], "dataset string, field string, check string, reason string")
    ff = literal_table(spark, [(r["name"], f) for r in registry for f in r.get("finding_fields", [])],
                               "dataset string, field string")
    return ds, known, ff


def run(spark: SparkSession, datasets: Mapping[str, DataFrame], registry: Sequence[Mapping],
        previous_snapshot: DataFrame | None = None, pairs: Sequence[tuple[str, str]] = (),
        expected_fields: Mapping[str, Sequence[str]] | None = None,
        numeric_hints: Sequence[str] = K.NUMERIC_NAME_HINTS, materialize: str = "checkpoint",
        distinct: str | None = "exact") -> dict[str, DataFrame]:
    """Profiles feed findings, drift, cross-source and the snapshot; with the default
    `materialize="checkpoint"` each dataset is scanned once however many outputs are
    written. Use "none" when only one output is consumed."""
    ds, known, ff = registry_frame(spark, registry)
    computed = {r["name"]: r.get("fields_computed", []) for r in registry}
    profiles, findings = None, None
    for name, df in datasets.items():
        p = Q.profile(df, name, numeric_hints=numeric_hints, materialize=materialize, distinct=distinct)
        profiles = p if profiles is None else profiles.unionByName(p)
        f = Q.findings_from_profile(p).select("dataset", "check", "field")
        if expected_fields and name in expected_fields:
            diff = Q.field_set_diff(expected_fields[name], df, computed.get(name, [])).where(F.col("status") != "present")
            f = f.unionByName(diff.select(F.lit(name).alias("dataset"),
                                          F.concat(F.lit("field_"), F.col("status")).alias("check"), "field"))
        findings = f if findings is None else findings.unionByName(f)
    fields = literal_table(spark, [(n, c) for n, df in datasets.items() for c in df.columns], "dataset string, field string")
    ghosts = Q.ghost_suppressions(known.select("dataset", "field", "check"), fields)
    kept = Q.apply_suppressions(findings, known).unionByName(
        ghosts.select("dataset", F.lit("ghost_suppression").alias("check"), "field").distinct())
    classified = Q.classify(kept, ff)
    out = {"profile": profiles, "findings": classified,
           "ghost_suppressions": ghosts,
           "status": Q.dataset_status(classified, ds),
           "summary": Q.findings_summary(classified, Q.suppressed_findings(findings, known))}
    if previous_snapshot is not None:
        out["drift"] = Q.drift(previous_snapshot, profiles)
    if pairs:
        counts = profiles.groupBy("dataset").agg(F.max("row_count").alias("rows"))
        pr = literal_table(spark, list(pairs), "left string, right string")
        out["cross_source"] = Q.cross_source(counts, pr)
    return out
