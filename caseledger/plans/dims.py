"""Dimensions: versioned agency, status, officer and service; calendar is in operators."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseledger.functions.columns import UNKNOWN_MEMBER, business_today
from caseledger.operators.calendar import CALENDAR_START, DAYS_AHEAD, extend_calendar
from caseledger.operators.joins import disjoint_ranges, lookup
from caseledger.operators.keys import with_unknown_member
from caseledger.operators.ranking import latest
from caseledger.operators.scd2 import current_attributes, scd2_apply
from caseledger.sources.tables import (delete_where, mirror_jdbc_staged, replace_all,
                                       upsert_current_state)
from caseledger.sources.readers import read_optional

# Texts of the unknown officer and of a missing role.
UNKNOWN_OFFICER = {"can_bo_id": UNKNOWN_MEMBER, "ten": "Khong xac dinh", "vi_tri": "N/A",
                   "source_snapshot_id": "SYSTEM"}
NO_ROLE = "Chua xac dinh vai tro"


@dataclass(frozen=True)
class Versioned:
    """How one dimension is keyed and what opens a new version."""
    table: str
    key: str
    tracked: tuple[str, ...]

    @property
    def sk(self) -> str:
        return f"{self.table}_sk"


AGENCY = Versioned("dim_co_quan", "co_quan_id", ("ten", "tinh", "phuong"))
STATUS = Versioned("dim_trang_thai", "trang_thai_id", ("ma_trang_thai", "ten_trang_thai"))
OFFICER = Versioned("dim_can_bo", "can_bo_id", ("ten", "vi_tri"))
SERVICE = Versioned("dim_dich_vu_cong", "dv_cong_id", ("ten", "thoi_han_tra_kq"))


def _newest_time(*columns: str):
    """A joined snapshot is as new as its newest part. ``greatest`` skips nulls."""
    return F.greatest(*columns).alias("source_snapshot_at")


def agency_snapshot(agency: DataFrame, province: DataFrame, ward: DataFrame) -> DataFrame:
    named = lookup(agency, province, {"Provinceid": "id"},
                   {"name": "tinh", "source_snapshot_at": "_province_at"})
    named = lookup(named, ward, {"Wardid": "id"},
                   {"name": "phuong", "source_snapshot_at": "_ward_at"})
    return named.select(F.col("id").alias("co_quan_id"), F.col("name").alias("ten"), "tinh",
                        "phuong", _newest_time("source_snapshot_at", "_province_at", "_ward_at"),
                        "source_snapshot_id")


def status_snapshot(status: DataFrame) -> DataFrame:
    return status.select(F.col("id").alias("trang_thai_id"), F.col("code").alias("ma_trang_thai"),
                         F.col("name").alias("ten_trang_thai"), "source_snapshot_at",
                         "source_snapshot_id")


def primary_role(officer_role: DataFrame) -> DataFrame:
    """One role per officer, the one with the lowest id."""
    return latest(officer_role, "Officerid", ["Roleid"], ascending=True)


def officer_snapshot(officer: DataFrame, officer_role: DataFrame, role: DataFrame) -> DataFrame:
    links = primary_role(officer_role)
    named = lookup(officer, links, {"id": "Officerid"},
                   {"Roleid": "_role", "source_snapshot_at": "_link_at"})
    named = lookup(named, role, {"_role": "id"},
                   {"name": "_role_name", "source_snapshot_at": "_role_at"})
    real = named.select(
        F.col("id").alias("can_bo_id"), F.col("name").alias("ten"),
        F.coalesce("_role_name", F.lit(NO_ROLE)).alias("vi_tri"),
        _newest_time("source_snapshot_at", "_link_at", "_role_at"), "source_snapshot_id")
    return with_unknown_member(real, **UNKNOWN_OFFICER)


def service_snapshot(service: DataFrame) -> DataFrame:
    return service.select(F.col("id").alias("dv_cong_id"), F.col("name").alias("ten"),
                          F.col("processing_time").alias("thoi_han_tra_kq"),
                          "source_snapshot_at", "source_snapshot_id")


def publish(dim: DataFrame, spec: Versioned, table: str) -> None:
    """Publish a dimension whose versions do not overlap within a key.

    :func:`scd2_apply` gives such ranges unless snapshots came out of order; whatever overlaps
    is repaired here, once, so that no lookup has to look for it.
    """
    named = dim.select("*", F.col(spec.key).alias("_v_key"), F.col("effective_from_ts").alias("_v_from"),
                       F.col("effective_to_ts").alias("_v_to"))
    repaired = disjoint_ranges(named, spec.sk)
    # A version closes where its part of the time ends.
    kept = repaired.withColumns({"effective_from_ts": F.col("_v_from"), "effective_to_ts": F.col("_v_to"),
                                 "is_current": F.col("is_current") & F.col("_v_to").isNull()}).select(*dim.columns)
    # Versions that were never in force stay as history; no lookup reads them.
    empty = F.col(spec.key).isNull() | F.col("effective_from_ts").isNull() | (F.col("effective_from_ts") >= F.col("effective_to_ts"))
    replace_all(kept.unionByName(dim.where(F.coalesce(empty, F.lit(False)))), table)


def build_dimension(spark: SparkSession, spec: Versioned, snapshot: DataFrame,
                    name=lambda table: table, serving_url: str | None = None, **jdbc) -> DataFrame:
    """Apply a snapshot, publish the new version, refresh the serving copy."""
    table = name(spec.table)
    publish(scd2_apply(read_optional(spark, table), snapshot, spec.key, spec.tracked, spec.sk), spec, table)
    stored = spark.table(table)
    if serving_url:
        mirror_jdbc_staged(current_attributes(stored, [spec.key, *spec.tracked]), serving_url,
                           spec.table, **jdbc)
    return stored


def build_calendar(spark: SparkSession, table: str = "dim_thoi_gian", today: date | None = None,
                   start: date = CALENDAR_START, days_ahead: int = DAYS_AHEAD,
                   serving_url: str | None = None, **jdbc) -> DataFrame:
    """Trim beyond the horizon, then add the missing days."""
    current = today or business_today()
    existing = read_optional(spark, table)
    if existing is not None:
        horizon = current + timedelta(days=days_ahead)
        if not existing.where(F.col("ngay_date") > F.lit(horizon)).isEmpty():
            delete_where(spark, table, f"ngay_date > DATE'{horizon.isoformat()}'")
        existing = spark.table(table)
    added = extend_calendar(spark, existing, current, start, days_ahead)
    if added is not None:
        upsert_current_state(added, table, "thoi_gian_id", buckets=1)
    stored = spark.table(table).drop("key_bucket")
    if serving_url:
        mirror_jdbc_staged(stored, serving_url, "dim_thoi_gian", **jdbc)
    return stored


def build_dims(spark: SparkSession, masters: dict[str, DataFrame], name=lambda table: table,
               serving_url: str | None = None, **jdbc) -> dict[str, DataFrame]:
    """The four versioned dimensions from the silver masters."""
    snapshots = {
        AGENCY: agency_snapshot(masters["agency"], masters["province"], masters["ward"]),
        STATUS: status_snapshot(masters["status"]),
        OFFICER: officer_snapshot(masters["officer"], masters["officer_role"], masters["role"]),
        SERVICE: service_snapshot(masters["service"]),
    }
    return {spec.table: build_dimension(spark, spec, snapshot, name, serving_url, **jdbc)
            for spec, snapshot in snapshots.items()}
