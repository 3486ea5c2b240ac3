"""State vocabularies: raw status words to lifecycle states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.columns import ColumnLike, col, literal_map

# Raw status word (lower case) to lifecycle state, per resource kind.
STATE_WORDS: dict[str, dict[str, str]] = {
    "cluster": {
        "ready": "RUNNING",
        "running": "RUNNING",
        "creating": "CREATING",
        "suspended": "SUSPENDED",
        "failed": "FAILED",
        "deleting": "DELETING",
    },
    "job": {
        "pending": "PENDING",
        "running": "RUNNING",
        "succeeded": "SUCCEEDED",
        "failed": "FAILED",
        "stopped": "STOPPED",
        "suspended": "SUSPENDED",
    },
    "service": {
        "running": "RUNNING",
        "deploying": "DEPLOYING",
        "waitforfailover": "DEPLOYING",
        "waitforserverapplication": "DEPLOYING",
        "unhealthy": "UNHEALTHY",
        "failed": "FAILED",
        "deleting": "DELETING",
    },
}

# States that end a job, and raw words of a job that still runs.
TERMINAL_JOB_STATES = ("SUCCEEDED", "FAILED", "STOPPED")
ACTIVE_JOB_WORDS = ("running", "pending")

# Legal lifecycle edges (kind, from state, to state).
LEGAL_EDGES: tuple[tuple[str, str, str], ...] = (
    ("cluster", "CREATING", "RUNNING"),
    ("cluster", "CREATING", "FAILED"),
    ("cluster", "RUNNING", "DELETING"),
    ("cluster", "RUNNING", "SUSPENDED"),
    ("cluster", "SUSPENDED", "RUNNING"),
    ("job", "PENDING", "RUNNING"),
    ("job", "PENDING", "SUSPENDED"),
    ("job", "RUNNING", "SUCCEEDED"),
    ("job", "RUNNING", "FAILED"),
    ("job", "RUNNING", "STOPPED"),
    ("job", "SUSPENDED", "PENDING"),
    ("submission", "PENDING", "RUNNING"),
    ("submission", "RUNNING", "SUCCEEDED"),
    ("submission", "RUNNING", "FAILED"),
    ("submission", "RUNNING", "STOPPED"),
)


def map_state(raw: ColumnLike, kind: str) -> Column:
    """Lifecycle state of a raw status word; anything unknown or missing is UNKNOWN."""
    words = literal_map(STATE_WORDS[kind])
    return F.coalesce(F.element_at(words, F.lower(col(raw))), F.lit("UNKNOWN"))


def is_active(raw: ColumnLike) -> Column:
    """True while a job is running or pending, in any letter case."""
    return F.coalesce(F.lower(col(raw)).isin(*ACTIVE_JOB_WORDS), F.lit(False))


def is_terminal(state: ColumnLike) -> Column:
    """True when a job has ended; suspended and unknown jobs have not."""
    return F.coalesce(col(state).isin(*TERMINAL_JOB_STATES), F.lit(False))


def is_legal_edge(kind: ColumnLike, from_state: ColumnLike, to_state: ColumnLike) -> Column:
    """True when a lifecycle change is in the table of legal edges."""
    edges = [">".join(edge) for edge in LEGAL_EDGES]
    return F.concat_ws(">", col(kind), col(from_state), col(to_state)).isin(*edges)


def condition_true(conditions: ColumnLike, type_name: str) -> Column:
    """True when any condition of that type carries the text ``True``."""
    holds = F.exists(
        col(conditions),
        lambda c: F.coalesce((c["type"] == type_name) & (c["status"] == "True"), F.lit(False)),
    )
    return F.coalesce(holds, F.lit(False))
