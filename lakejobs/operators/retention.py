"""Retention rules as filters."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.functions import clock

# How long each layer and each class of data is kept.
LAYER_RETENTION = {
    "bronze": "7-years", "silver": "7-years", "gold": "7-years",
    "archive": "permanent", "quarantine": "30-days",
}
PROD_RETENTION = {**LAYER_RETENTION, "quarantine": "90-days"}
DEV_RETENTION = {"bronze": "30-days", "silver": "30-days", "gold": "30-days",
                 "sandbox": "7-days"}
CLASS_RETENTION = {"PII": "7-years", "PHI": "7-years", "FINANCIAL": "10-years"}


def cutoff(policy: str, now: Column) -> Column | None:
    """Oldest moment kept under a policy such as ``30-days``; None for permanent."""
    if policy == "permanent":
        return None
    parts = re.fullmatch(r"(\d+)[-_](days|years)", policy.lower())
    if not parts:
        raise ValueError(f"unknown retention policy {policy}")
    return now - F.expr(f"INTERVAL '{parts[1]}' {parts[2][:-1].upper()}")


def prune(
    df: DataFrame, ts_col: str, policy: str | dict[str, str], as_of: str | Column | None = None,
    class_col: str | None = None,
) -> DataFrame:
    """Rows still within their retention time; rows without a time stay.

    With ``class_col`` the policy is a map by class; a class without an entry is
    kept.  The cut-offs are constants, so the scan can skip old files.
    """
    now = clock.moment(df, ts_col, as_of)
    if isinstance(policy, str):
        oldest = cutoff(policy, now)
        if oldest is None:
            return df
        return df.filter((F.col(ts_col) >= oldest) | F.col(ts_col).isNull())
    kind = F.col(class_col)
    expired = []
    for name, text in policy.items():
        oldest = cutoff(text, now)
        if oldest is not None:
            expired.append((kind == name) & (F.col(ts_col) < oldest))
    if not expired:
        return df
    gone = reduce(lambda a, b: a | b, expired)
    return df.filter(~F.coalesce(gone, F.lit(False)))
