"""Canonical JSON, map overlays and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.columns import ColumnLike, blank_to_null, col

# Label keys and environment variables of the platforms.
QUEUE_LABEL = "kueue.x-k8s.io/queue-name"
PRIORITY_LABEL = "kueue.x-k8s.io/priority-class"
TRACKING_URI_VARIABLE = "MLFLOW_TRACKING_URI"
TRACKING_EXPERIMENT_VARIABLE = "MLFLOW_EXPERIMENT_NAME"
DASHBOARD_PORT = 8265

_EMPTY_MAP = "map<string,string>"


# Fixed value: a number written with an exponent.
_EXPONENT = "[0-9][eE][+-]?[0-9]"


def canonical_json(text: ColumnLike) -> Column:
    """JSON text with sorted keys and normalised numbers; text that is no JSON stays as it is.

    A number with an exponent comes out of the first pass as a plain decimal with
    a fraction, which the second pass writes like any other.
    """
    once = F.to_json(F.try_parse_json(col(text)))
    twice = F.when(col(text).rlike(_EXPONENT), F.to_json(F.try_parse_json(once))).otherwise(once)
    return F.coalesce(twice, col(text))


def spec_digest(text: ColumnLike) -> Column:
    """SHA-256 of the canonical text: equal digests mean equal documents.

    Comparing 64 characters keeps wide documents out of the shuffle.
    """
    return F.sha2(canonical_json(text), 256)


def map_or_empty(value: ColumnLike) -> Column:
    return F.coalesce(col(value), F.create_map().cast(_EMPTY_MAP))


def merge_env(base: ColumnLike, extra: ColumnLike) -> Column:
    """Union of two maps where the right side wins; NULL counts as empty."""
    left, right = map_or_empty(base), map_or_empty(extra)
    kept = F.map_filter(left, lambda key, _: ~F.map_contains_key(right, key))
    return F.map_concat(kept, right)


def tracking_env(uri: ColumnLike, experiment: ColumnLike, user_vars: ColumnLike) -> Column:
    """Environment of experiment tracking: address, optional name, then the user's variables."""
    named = F.when(
        blank_to_null(experiment).isNotNull(),
        F.create_map(F.lit(TRACKING_EXPERIMENT_VARIABLE), col(experiment)),
    )
    base = F.create_map(F.lit(TRACKING_URI_VARIABLE), col(uri))
    return merge_env(merge_env(base, named), user_vars)


def queue_labels(labels: ColumnLike, queue: ColumnLike, priority: ColumnLike | None = None) -> Column:
    """Labels with the queue label set and, where given, the priority label."""
    merged = merge_env(labels, F.create_map(F.lit(QUEUE_LABEL), col(queue)))
    if priority is None:
        return merged
    ranked = F.when(
        col(priority).isNotNull(), F.create_map(F.lit(PRIORITY_LABEL), col(priority))
    )
    return merge_env(merged, ranked)


def service_ip_url(ip: ColumnLike) -> Column:
    """Dashboard address of a head service address, NULL when there is none."""
    return F.when(
        blank_to_null(ip).isNotNull(),
        F.concat(F.lit("http://"), col(ip), F.lit(f":{DASHBOARD_PORT}")),
    )


def resolve_namespace(*candidates: ColumnLike) -> Column:
    """First namespace that is neither missing nor empty, else ``default``."""
    return F.coalesce(*[blank_to_null(c) for c in candidates], F.lit("default"))


# Objects that lie in both documents are merged down to this depth; manifests have about ten levels.
MERGE_DEPTH = 32
# Stands for objects nested more deeply than that, until the document that holds it is given up.
_TOO_DEEP = "\x00nested too deeply to be merged\x00"
_ENTRIES = "map<string,variant>"


def _entries(value: Column) -> Column:
    """The entries of a variant that is an object, else NULL."""
    return F.try_variant_get(value, "$", _ENTRIES)


def _merged(base: Column, override: Column, depth: int) -> Column:
    left, right = _entries(base), _entries(override)
    if not depth:
        both = F.to_variant_object(F.array(F.lit(_TOO_DEEP)))
    else:
        # A key that a side lacks is NULL there; a null in the document is a variant.
        joint = F.map_zip_with(
            left, right, lambda _, b, o: F.when(o.isNull(), b).when(b.isNull(), o).otherwise(_merged(b, o, depth - 1))
        )
        both = F.to_variant_object(joint)
    return F.when(left.isNotNull() & right.isNotNull(), both).otherwise(override)


def merge_json(base: ColumnLike, override: ColumnLike, depth: int = MERGE_DEPTH) -> Column:
    """A JSON document overlaid with free-form overrides, NULL where these are no JSON object.

    Objects merge key by key, anything else in the override replaces what is in the base. An
    object with a key twice is no JSON here. So is an override with more than ``depth`` levels
    of objects that the base has too. For overrides kept as leaf rows use ``overlay.deep_merge``.
    """
    given = blank_to_null(override)
    over = F.try_parse_json(given)
    merged = F.to_json(F.when(_entries(over).isNotNull(), _merged(F.try_parse_json(col(base)), over, depth)))
    whole = F.when(~merged.contains("\\u0000nested too deeply"), merged)
    return F.when(given.isNull(), col(base)).when(col(base).isNotNull(), whole)
