"""Exception register: every doubtful row with a code, severity, owner and next step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
SEVERITIES = ("critical", "high", "medium", "low")
RETRY_STATUSES = ("auto-retryable", "needs-decision", "wont-fix", "resolved")
CLIENT, AGENCY = "client", "agency"

COLUMNS = [
    "record_type", "record_id", "record_ref", "stage", "severity",
    "code", "message", "owner", "retry_status", "detail",
]


@dataclass(frozen=True)
class Rule:
    """One check: rows where ``when`` is true give an exception row."""

    when: Column
    code: str | Column
    severity: str
    message: str | Column
    owner: str = CLIENT
    retry: str = "needs-decision"
    detail: Column | None = None
    record_type: str | None = None
    record_id: Column | None = None
    record_ref: Column | None = None

    def __post_init__(self) -> None:
        if self.severity not in SEVERITIES:
            raise ValueError(f"unknown severity {self.severity!r}")
        if self.retry not in RETRY_STATUSES:
            raise ValueError(f"unknown retry status {self.retry!r}")


def _lit(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def exceptions_from_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    record_type: str,
    record_id: Column,
    record_ref: Column,
    stage: str = "transform",
) -> DataFrame:
    """All rules in one pass over ``df``: an array of hits per row, exploded."""
    hits = [
        F.when(
            rule.when,
            F.struct(
                F.lit(rule.record_type or record_type).alias("record_type"),
                (record_id if rule.record_id is None else rule.record_id).cast("string").alias("record_id"),
                (record_ref if rule.record_ref is None else rule.record_ref).alias("record_ref"),
                F.lit(stage).alias("stage"),
                F.lit(rule.severity).alias("severity"),
                _lit(rule.code).alias("code"),
                _lit(rule.message).alias("message"),
                F.lit(rule.owner).alias("owner"),
                F.lit(rule.retry).alias("retry_status"),
                (F.lit("{}") if rule.detail is None else F.to_json(rule.detail)).alias("detail"),
            ),
        )
        for rule in rules
    ]
    return df.select(F.explode(F.array_compact(F.array(*hits))).alias("e")).select("e.*")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def severity_rank(c: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), c)


def exception_order(df: DataFrame) -> DataFrame:
    """Register order: severity, code, record type, id as text."""
    return df.orderBy(severity_rank(F.col("severity")), "code", "record_type", "record_id")


def exceptions_by_severity(df: DataFrame) -> DataFrame:
    """Rows per severity, zero where none."""
    known = df.sparkSession.createDataFrame([(s,) for s in SEVERITIES], "severity string")
    counts = df.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    return known.join(counts, "severity", "left").select("severity", F.coalesce("n", F.lit(0)).alias("n"))


def exceptions_by_code(df: DataFrame) -> DataFrame:
    return df.groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "code")
