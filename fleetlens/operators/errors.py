"""Error classes, remediation texts and transience."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import ColumnLike, col, literal_map

# Statuses worth a retry, and parts of exception names that are.
TRANSIENT_STATUSES = (429, 500, 502, 503, 504)
TRANSIENT_NAMES = "timeout|connection|broken"

# Resource kinds with a not-found class of their own.
NOT_FOUND_BY_KIND = {
    "RayCluster": "CLUSTER_NOT_FOUND",
    "RayJob": "JOB_NOT_FOUND",
    "RayService": "SERVICE_NOT_FOUND",
}

REMEDIATION = {
    "CLUSTER_NOT_FOUND": "List the clusters of the namespace and check the name and namespace.",
    "JOB_NOT_FOUND": "List the jobs of the namespace and check the name and namespace.",
    "SERVICE_NOT_FOUND": "List the services of the namespace and check the name and namespace.",
    "NOT_FOUND": "Check that the resource exists in the namespace you are looking at.",
    "AUTHENTICATION": "Renew the credentials and check the permissions of the account.",
    "CONFLICT": "Compare the existing resource with the wanted one; delete it before creating it anew.",
    "VALIDATION": "Compare the specification with the schema of its kind and correct the invalid fields.",
    "SERVER_ERROR": "Check the health of the API server; the error usually passes.",
    "GENERIC": "Look at the status and the events of the resource.",
}


def is_transient(status: ColumnLike, exception: ColumnLike) -> Column:
    """True for errors worth a retry, by status or by the name of the exception class."""
    by_status = F.coalesce(col(status).isin(*TRANSIENT_STATUSES), F.lit(False))
    by_name = F.coalesce(F.lower(col(exception)).rlike(TRANSIENT_NAMES), F.lit(False))
    return by_status | by_name


def error_category(status: ColumnLike, kind: ColumnLike) -> Column:
    """Error class of an HTTP status; a missing resource is classed by its kind."""
    code = F.coalesce(col(status), F.lit(0))
    return (
        F.when(
            code == 404,
            F.coalesce(F.element_at(literal_map(NOT_FOUND_BY_KIND), col(kind)), F.lit("NOT_FOUND")),
        )
        .when(code.isin(401, 403), "AUTHENTICATION")
        .when(code == 409, "CONFLICT")
        .when(code == 422, "VALIDATION")
        .when((code >= 500) & (code < 600), "SERVER_ERROR")
        .otherwise("GENERIC")
    )


def classify_errors(
    df: DataFrame, status: str = "http_status", kind: str = "kind", exception: str | None = None
) -> DataFrame:
    """Add error class, remediation text and transience to rows of API errors."""
    name = F.col(exception) if exception else F.lit(None).cast("string")
    classed = df.withColumn("category", error_category(status, kind))
    return classed.withColumns(
        {
            "remediation": F.element_at(literal_map(REMEDIATION), F.col("category")),
            "transient": is_transient(status, name),
        }
    )


def error_summary(errors: DataFrame, dims: tuple[str, ...] = ("category", "kind")) -> DataFrame:
    """Error counts by class and kind, with the number worth a retry."""
    return errors.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("errors"), F.count_if("transient").alias("transient_errors")
    )
