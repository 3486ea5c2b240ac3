"""Explicit schemas of the documents and tables the operators read.

Schemas are never inferred: inference would drop absent fields and mistype
empty arrays. Every field is nullable, because a missing field is normal.
"""

from __future__ import annotations

POD = """struct<spec: struct<
  containers: array<struct<name: string, image: string,
    resources: struct<requests: map<string,string>, limits: map<string,string>>,
    volumeMounts: array<struct<name: string, mountPath: string>>>>,
  volumes: array<struct<name: string, persistentVolumeClaim: struct<claimName: string>>>,
  nodeSelector: map<string,string>,
  tolerations: array<map<string,string>>>>"""

METADATA = """struct<name: string, namespace: string, creationTimestamp: string,
  labels: map<string,string>, annotations: map<string,string>>"""

CLUSTER_SPEC = f"""struct<rayVersion: string, enableInTreeAutoscaling: boolean,
  headGroupSpec: struct<rayStartParams: map<string,string>, template: {POD}>,
  workerGroupSpecs: array<struct<groupName: string, replicas: int, minReplicas: int,
    maxReplicas: int, rayStartParams: map<string,string>, template: {POD}>>>"""

_SPEC_AND_STATUS = {
    "cluster": f"""spec: {CLUSTER_SPEC},
      status: struct<state: string, head: struct<podIP: string, serviceIP: string>,
        readyWorkerReplicas: int, desiredWorkerReplicas: int,
        conditions: array<struct<type: string, status: string, reason: string, message: string>>>""",
    "job": f"""spec: struct<entrypoint: string, runtimeEnvYAML: string,
        shutdownAfterJobFinishes: boolean, rayClusterSpec: {CLUSTER_SPEC}>,
      status: struct<jobStatus: string, jobDeploymentStatus: string, startTime: string,
        endTime: string, message: string, rayClusterName: string>""",
    "service": f"""spec: struct<serveConfigV2: string, rayClusterConfig: {CLUSTER_SPEC}>,
      status: struct<serviceStatus: string,
        activeServiceStatus: struct<applicationStatuses: map<string, struct<status: string,
          serveDeploymentStatuses: array<struct<healthyReplicas: int, desiredReplicas: int>>>>>,
        dashboardStatus: struct<isHealthy: boolean, dashboardUrl: string>>""",
    "queue": "spec: struct<clusterQueue: string>, status: struct<pendingWorkloads: int>",
    "hardware_profile": """spec: struct<
        identifiers: array<struct<displayName: string, identifier: string, resourceType: string,
          defaultCount: string, minCount: string, maxCount: string>>,
        scheduling: struct<schedulingType: string,
          node: struct<nodeSelector: map<string,string>, tolerations: array<map<string,string>>>,
          kueue: struct<localQueueName: string, priorityClass: string>>>""",
    "route": "spec: struct<host: string, to: struct<name: string>, tls: map<string,string>>",
    "ingress": """spec: struct<tls: array<struct<hosts: array<string>>>,
        rules: array<struct<host: string, http: struct<paths: array<struct<
          backend: struct<service: struct<name: string>>>>>>>>""",
}

RESOURCE_KINDS = tuple(_SPEC_AND_STATUS)

# The part of a specification that status rows read; parsing skips the pod templates.
_STATUS_CLUSTER_SPEC = "struct<rayVersion: string>"


def resource_schema(kind: str, status_only: bool = False) -> str:
    """DDL of one resource document of the given kind.

    ``status_only`` leaves out what no status row reads, so that the parser
    skips it instead of building it.
    """
    if kind not in _SPEC_AND_STATUS:
        raise ValueError(f"unknown resource kind {kind!r}; expected one of {RESOURCE_KINDS}")
    parts = _SPEC_AND_STATUS[kind]
    if status_only:
        parts = parts.replace(CLUSTER_SPEC, _STATUS_CLUSTER_SPEC)
    return f"struct<apiVersion: string, kind: string, metadata: {METADATA}, {parts}>"


SUBMISSION = """job_id string, submission_id string, status string, entrypoint string,
  message string, start_time bigint, end_time bigint, metadata map<string,string>, runtime_env string"""

NODES = "cluster string, node string, allocatable map<string,string>, http_status int"

API_TYPES = """cluster string, crd_name string, labels map<string,string>,
  annotations map<string,string>, http_status int"""

METRICS = "cluster string, observed_at timestamp, payload string"

SNAPSHOTS = """kind string, namespace string, name string, observed_at timestamp, seq bigint,
  state string, head_ready boolean, message string, metadata map<string,string>"""

LOG_LINES = "job_id string, line_no bigint, line string"
