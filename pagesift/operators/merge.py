"""List cards and profile pages brought together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift import fixed_values as fv
from pagesift.operators.skew import spread_join

_LIST_FIELDS = ["npsn", "nama_sekolah", "status_sekolah", "alamat_jalan"]


def _joined(cards: DataFrame, details: DataFrame) -> DataFrame:
    """Cards with the profile behind their URL; cards without a URL or a profile drop out."""
    listed = cards.where(F.col("url").isNotNull() & (F.col("url") != ""))
    listed = listed.withColumnsRenamed({c: "list_" + c for c in _LIST_FIELDS})
    return spread_join(listed, details, "url")


def _in_order(joined: DataFrame, merged: dict, lineage: list[str]) -> DataFrame:
    return joined.select(*lineage, *[merged[c].alias(c) if c in merged else F.col(c) for c in fv.PROFILE_COLUMNS])


def merge_detail_first(cards: DataFrame, details: DataFrame, *lineage: str) -> DataFrame:
    """What the profile says wins; the card fills the gaps."""
    merged = {c: F.coalesce(F.col(c), F.col("list_" + c)) for c in ("npsn", "nama_sekolah", "status_sekolah")}
    merged["alamat_jalan"] = F.col("list_alamat_jalan")
    return _in_order(_joined(cards, details), merged, list(lineage))


def merge_list_first(cards: DataFrame, details: DataFrame, *lineage: str) -> DataFrame:
    """What the card says wins; the profile fills the gaps."""
    merged = {c: F.coalesce(F.col("list_" + c), F.col(c)) for c in ("nama_sekolah", "status_sekolah")}
    merged["npsn"] = F.col("list_npsn")
    merged["alamat_jalan"] = F.coalesce(F.col("list_alamat_jalan"), F.col("alamat_sekolah"))
    return _in_order(_joined(cards, details), merged, list(lineage))


def published_profiles(rows: DataFrame) -> DataFrame:
    """The 39 columns in order, gaps marked."""
    return rows.select(*fv.PROFILE_COLUMNS).na.fill(fv.MISSING)
