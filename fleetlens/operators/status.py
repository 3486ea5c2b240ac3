"""Flat status rows from nested resource documents, and list views of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.clock import AsOf, age_label, age_us, instant, job_duration_us, parse_instant
from fleetlens.functions.columns import blank_to_null, col
from fleetlens.functions.documents import service_ip_url
from fleetlens.functions.serving import declared_replicas, with_declared_replicas
from fleetlens.functions.states import condition_true, is_terminal, map_state

HEAD_READY_CONDITION = "HeadPodReady"


def _identity() -> list[Column]:
    return [
        F.coalesce(F.col("metadata.name"), F.lit("")).alias("name"),
        F.coalesce(F.col("metadata.namespace"), F.lit("default")).alias("namespace"),
    ]


def cluster_status(df: DataFrame, as_of: AsOf) -> DataFrame:
    """One status row per cluster document."""
    conditions = F.col("status.conditions")
    return df.select(
        *_identity(),
        map_state("status.state", "cluster").alias("state"),
        condition_true(conditions, HEAD_READY_CONDITION).alias("head_ready"),
        F.coalesce(F.col("status.readyWorkerReplicas"), F.lit(0)).alias("workers_ready"),
        F.coalesce(F.col("status.desiredWorkerReplicas"), F.lit(0)).alias("workers_desired"),
        F.coalesce(F.col("spec.rayVersion"), F.lit("")).alias("version"),
        service_ip_url("status.head.serviceIP").alias("dashboard_url"),
        age_us("metadata.creationTimestamp", as_of).alias("age_us"),
        F.coalesce(conditions, F.array()).alias("conditions"),
    )


def job_status(df: DataFrame, as_of: AsOf) -> DataFrame:
    """One status row per job document; a missing submission time reads as ``as_of``."""
    state = map_state("status.jobStatus", "job")
    return df.select(
        *_identity(),
        state.alias("state"),
        F.lit("CRD").alias("mode"),
        F.coalesce(F.col("spec.entrypoint"), F.lit("")).alias("entrypoint"),
        F.coalesce(parse_instant("metadata.creationTimestamp"), instant(as_of)).alias("submitted_at"),
        job_duration_us("status.startTime", "status.endTime", state, as_of).alias("duration_us"),
        blank_to_null("status.message").alias("error_message"),
        blank_to_null("status.rayClusterName").alias("cluster_name"),
    )


def submission_status(df: DataFrame) -> DataFrame:
    """One status row per dashboard submission."""
    state = F.upper(F.coalesce(F.col("status"), F.lit("")))
    return df.select(
        F.coalesce(blank_to_null("job_id"), F.col("submission_id")).alias("name"),
        state.alias("state"),
        is_terminal(state).alias("terminal"),
        F.coalesce(F.col("entrypoint"), F.lit("")).alias("entrypoint"),
        F.coalesce(F.col("message"), F.lit("")).alias("message"),
        F.timestamp_millis(F.nullif(F.col("start_time"), F.lit(0))).alias("started_at"),
        F.timestamp_millis(F.nullif(F.col("end_time"), F.lit(0))).alias("ended_at"),
    )


def _replica_sum(deployments: Column, field: str) -> Column:
    counts = F.transform(deployments, lambda d: F.coalesce(d[field], F.lit(0)))
    return F.coalesce(F.aggregate(counts, F.lit(0), lambda total, n: total + n), F.lit(0))


def service_replicas(applications: Column, serve_config: Column) -> tuple[Column, Column]:
    """Ready and desired replicas over all deployments of a service.

    When the observed desired count is 0 the declared configuration counts
    instead. Only those configurations are sent to the parser.
    """
    deployments = F.flatten(
        F.transform(
            F.map_values(applications),
            lambda app: F.coalesce(app["serveDeploymentStatuses"], F.array()),
        )
    )
    ready = _replica_sum(deployments, "healthyReplicas")
    observed = _replica_sum(deployments, "desiredReplicas")
    declared = declared_replicas(F.when(observed == 0, serve_config))
    desired = F.when(observed == 0, F.coalesce(declared, F.lit(0))).otherwise(observed)
    return ready, desired


def with_replicas(df: DataFrame, applications: str, serve_config: str) -> DataFrame:
    """``service_replicas`` as columns ``replicas_ready`` and ``replicas_desired`` in place of their sources.

    Step by step, so that no count is worked out more than once for a row.
    """
    deployments = F.flatten(
        F.transform(F.map_values(applications), lambda app: F.coalesce(app["serveDeploymentStatuses"], F.array()))
    )
    counted = df.withColumn("_deployments", deployments).withColumns(
        {
            "replicas_ready": _replica_sum(F.col("_deployments"), "healthyReplicas"),
            "_observed": _replica_sum(F.col("_deployments"), "desiredReplicas"),
        }
    )
    told = with_declared_replicas(counted.withColumn("_config", F.when(F.col("_observed") == 0, F.col(serve_config))), "_config", "_declared")
    desired = F.when(F.col("_observed") == 0, F.coalesce(F.col("_declared"), F.lit(0))).otherwise(F.col("_observed"))
    return told.withColumn("replicas_desired", desired).drop(
        applications, serve_config, "_deployments", "_observed", "_config", "_declared"
    )


def service_status(df: DataFrame, as_of: AsOf) -> DataFrame:
    """One status row per service document."""
    dashboard = F.col("status.dashboardStatus")
    rows = df.select(
        *_identity(),
        map_state("status.serviceStatus", "service").alias("state"),
        F.when(dashboard["isHealthy"], dashboard["dashboardUrl"]).alias("endpoint_url"),
        F.lit(None).cast("string").alias("route_url"),
        F.col("status.activeServiceStatus.applicationStatuses").alias("_applications"),
        F.col("spec.serveConfigV2").alias("_serve_config"),
        age_us("metadata.creationTimestamp", as_of).alias("age_us"),
    )
    return with_replicas(rows, "_applications", "_serve_config").select(
        "name", "namespace", "state", "endpoint_url", "route_url", "replicas_ready", "replicas_desired", "age_us"
    )


def list_view(status: DataFrame, kind: str, as_of: AsOf | None = None) -> DataFrame:
    """The columns a listing shows: name, state, one detail and a short age."""
    if kind == "job":
        if as_of is None:
            raise ValueError("a job listing needs as_of to tell ages")
        age = F.unix_micros(instant(as_of)) - F.unix_micros(F.col("submitted_at"))
        detail = F.col("entrypoint")
    else:
        age = F.col("age_us")
        column = {"cluster": "workers_ready", "service": "replicas_ready"}[kind]
        detail = F.col(column).alias("workers" if kind == "cluster" else "replicas")
    return status.select("name", "state", detail, age_label(age).alias("age"))


def in_namespace(df: DataFrame, namespace: str, column: str = "namespace") -> DataFrame:
    """Rows of one namespace; prunes partitions where the data is laid out by namespace."""
    return df.where(col(column) == namespace)


def unify_jobs(jobs: DataFrame, submissions: DataFrame) -> DataFrame:
    """One job table from job documents and dashboard submissions, told apart by ``mode``."""
    crd = jobs.withColumnRenamed("error_message", "message")
    dashboard = submissions.withColumn("mode", F.lit("DASHBOARD")).withColumnRenamed(
        "started_at", "submitted_at"
    )
    ended = F.unix_micros("ended_at") - F.unix_micros("submitted_at")
    return crd.unionByName(
        dashboard.withColumn("duration_us", ended).drop("terminal", "ended_at"),
        allowMissingColumns=True,
    )
