"""Data-quality rules over request tables.

``validate`` lists every violation, one row each, in a single pass without a
shuffle. A NULL field means the field was not given. Rules whose columns a
table lacks do not apply to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import blank_to_null
from fleetlens.operators.inventory import MAX_POD_SETS, podsets_of

# Patterns and domains of valid requests.
NAME_PATTERN = r"^[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?$"
ACCESS_MODES = ("ReadWriteOnce", "ReadOnlyMany", "ReadWriteMany")
TRACKING_PROVIDER = "mlflow"
MANIFEST_KEYS = ("apiVersion", "kind", "metadata", "spec")
_DIGITS = "[0-9]+(_[0-9]+)*"
WHOLE_NUMBER = rf"^\s*[+-]?{_DIGITS}\s*$"
NUMBER = (
    rf"(?i)^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity|nan)\s*$"
)

ALL_KINDS = ("cluster", "job", "service")


def _given(name: str) -> Column:
    return blank_to_null(name).isNotNull()


def _any_group(test: Callable[[Column], Column]) -> Column:
    return F.exists("worker_groups", test)


def _any_volume(test: Callable[[Column], Column]) -> Column:
    return F.exists("storage", test)


def _bad_bounds(group: Column) -> Column:
    low = F.coalesce(group["min_replicas"], group["replicas"])
    high = F.coalesce(group["max_replicas"], group["replicas"])
    return (low > group["replicas"]) | (group["replicas"] > high) | (low > high)


def _flat_and_groups(*explaining: str) -> Column:
    """Flat worker count next to groups, unless a plain merge of settings explains it.

    An explaining field with none of the other flat fields tells that the count
    came from merged settings; then the groups win silently.
    """
    both = F.col("worker_groups").isNotNull() & F.col("workers").isNotNull()
    other_flat = (
        F.col("cpus_per_worker").isNotNull()
        | F.col("gpus_per_worker").isNotNull()
        | F.col("memory_per_worker").isNotNull()
    )
    explained = F.lit(False)
    for name in explaining:
        explained = explained | F.col(name).isNotNull()
    return both & (other_flat | ~explained)


def _size_xor_claim(volume: Column) -> Column:
    has_size = blank_to_null(volume["size"]).isNotNull()
    return has_size == blank_to_null(volume["existing_claim"]).isNotNull()


FLAT = ("worker_groups", "workers", "cpus_per_worker", "gpus_per_worker", "memory_per_worker")


@dataclass(frozen=True)
class Rule:
    """``violated`` is true where a request breaks the rule; NULL counts as kept."""

    rule_id: str
    kinds: tuple[str, ...]
    needs: tuple[str, ...]
    message: str
    violated: Callable[[], Column]


RULES: tuple[Rule, ...] = (
    Rule("V01", ALL_KINDS, ("name",), "name must be 1-63 lower-case letters, digits or inner hyphens",
         lambda: ~F.coalesce(F.col("name").rlike(NAME_PATTERN), F.lit(False))),
    Rule("V02", ALL_KINDS, ("worker_groups",), "group replicas must be at least 1",
         lambda: _any_group(lambda g: g["replicas"] < 1)),
    Rule("V03", ALL_KINDS, ("worker_groups",), "group bounds must satisfy min <= replicas <= max",
         lambda: _any_group(_bad_bounds)),
    Rule("V04", ALL_KINDS, ("workers",), "workers must be at least 1",
         lambda: F.col("workers") < 1),
    Rule("V05", ALL_KINDS, ("cpus_per_worker",), "cpus per worker must be above 0",
         lambda: F.col("cpus_per_worker") <= 0),
    Rule("V06", ALL_KINDS, ("gpus_per_worker",), "gpus per worker must not be negative",
         lambda: F.col("gpus_per_worker") < 0),
    Rule("V07", ("cluster",), (*FLAT, "namespace", "ray_version"), "give either workers or worker groups",
         lambda: _flat_and_groups("namespace", "ray_version")),
    Rule("V08", ("job",), (*FLAT, "namespace", "ray_version", "name", "entrypoint"),
         "give either workers or worker groups",
         lambda: _flat_and_groups("namespace", "ray_version", "name", "entrypoint")),
    Rule("V09", ("job",), ("entrypoint",), "entrypoint must not be blank",
         lambda: ~F.coalesce(F.col("entrypoint").rlike(r"\S"), F.lit(False))),
    Rule("V10", ("job",), ("queue", "shutdown_after_finish"), "a queued job must shut down after it finishes",
         lambda: _given("queue") & ~F.col("shutdown_after_finish")),
    Rule("V11", ("service",), ("import_path", "serve_config_v2"),
         "give exactly one of import path and serve configuration",
         lambda: _given("import_path") == _given("serve_config_v2")),
    Rule("V12", ("service",), ("num_replicas",), "service replicas must be at least 1",
         lambda: F.col("num_replicas") < 1),
    Rule("V13", ALL_KINDS, ("storage",), "a volume needs exactly one of size and existing claim",
         lambda: _any_volume(_size_xor_claim)),
    Rule("V14", ALL_KINDS, ("storage",), "a volume's mount path must be absolute",
         lambda: _any_volume(lambda v: ~v["mount_path"].startswith("/"))),
    Rule("V15", ALL_KINDS, ("storage",), "a volume's access mode must be a known one",
         lambda: _any_volume(lambda v: ~v["access_mode"].isin(*ACCESS_MODES))),
    Rule("V16", ALL_KINDS, ("runtime_env",), "a runtime environment takes pip or conda, not both",
         lambda: (F.size("runtime_env.pip") > 0) & _given("runtime_env.conda")),
    Rule("V17", ("job",), ("experiment_tracking",), "the tracking provider is not supported",
         lambda: F.col("experiment_tracking.provider") != TRACKING_PROVIDER),
    Rule("V18", ("cluster", "job"), ("worker_groups", "queue"), "a queued workload has too many worker groups",
         lambda: _given("queue") & (podsets_of("worker_groups") > MAX_POD_SETS)),
    Rule("V19", ("settings",), ("retry_max_attempts", "retry_backoff_factor", "retry_timeout"),
         "attempts must not be negative; backoff and timeout must be above 0",
         lambda: (F.col("retry_max_attempts") < 0) | (F.col("retry_backoff_factor") <= 0)
         | (F.col("retry_timeout") <= 0)),
    Rule("V20", ("settings_text",), ("retry_max_attempts", "retry_backoff_factor", "retry_timeout"),
         "settings texts must be numbers",
         lambda: (F.col("retry_max_attempts").isNotNull() & ~F.col("retry_max_attempts").rlike(WHOLE_NUMBER))
         | _not_a_number("retry_backoff_factor") | _not_a_number("retry_timeout")),
    Rule("V21", ("manifest",), ("manifest",), "a manifest needs its four top-level keys",
         lambda: ~F.coalesce(
             F.size(F.array_intersect(
                 F.json_object_keys("manifest"), F.array(*[F.lit(k) for k in MANIFEST_KEYS])
             )) == len(MANIFEST_KEYS), F.lit(False))),
    Rule("V22", ALL_KINDS, ("worker_groups",), "group names must be unique",
         lambda: F.size(F.array_distinct("worker_groups.name")) < F.size("worker_groups.name")),
)


def _not_a_number(name: str) -> Column:
    return F.col(name).isNotNull() & ~F.col(name).rlike(NUMBER)


def rules_for(kind: str, columns: Iterable[str], rules: Iterable[Rule] = RULES) -> list[Rule]:
    """Rules that apply to a kind of request and find their columns."""
    present = set(columns)
    return [rule for rule in rules if kind in rule.kinds and present.issuperset(rule.needs)]


def unchecked_rules(kind: str, columns: Iterable[str], rules: Iterable[Rule] = RULES) -> list[tuple[str, list[str]]]:
    """Rules that apply to a kind of request but can't be checked, each with the columns it misses."""
    present = set(columns)
    return [(r.rule_id, sorted(set(r.needs) - present)) for r in rules if kind in r.kinds and not present.issuperset(r.needs)]


def unchecked(requests: DataFrame, kind: str, rules: Iterable[Rule] = RULES) -> DataFrame:
    """``(kind, rule_id, missing)``: what ``validate`` can't tell about these requests, and why."""
    found = [(kind, rule_id, missing) for rule_id, missing in unchecked_rules(kind, requests.columns, rules)]
    return requests.sparkSession.createDataFrame(found, "kind string, rule_id string, missing array<string>")


def validate(
    requests: DataFrame, kind: str, keys: tuple[str, ...] = ("namespace", "name"), rules: Iterable[Rule] = RULES
) -> DataFrame:
    """All rule violations as ``(kind, *keys, rule_id, message)``.

    ``kind`` is cluster, job or service, or one of the other validated records:
    settings, settings_text, manifest.
    """
    checks = [
        F.when(rule.violated(), F.struct(F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.message).alias("message")))
        for rule in rules_for(kind, requests.columns, rules)
    ]
    if not checks:
        raise ValueError(f"no rule applies to {kind!r} requests with columns {requests.columns}")
    found = F.filter(F.array(*checks), lambda v: v.isNotNull())
    return requests.select(
        F.lit(kind).alias("kind"), *keys, F.explode(found).alias("violation")
    ).select("kind", *keys, "violation.rule_id", "violation.message")
