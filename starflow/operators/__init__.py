from starflow.operators.asof import asof_join
from starflow.operators.changes import version_changes
from starflow.operators.clustering import lookup, write_clustered
from starflow.operators.dedupe import any_per_key, latest_per_key, only_latest
from starflow.operators.joins import aligned_join, left_enrich
from starflow.operators.keys import dense_key, hash_key, next_key
from starflow.operators.merge import append_new, insert_keyed, new_rows, upsert
from starflow.operators.quality import (
    checked,
    conform,
    fk_orphans,
    misfits,
    observed,
    pk_violations,
    quarantined_rows,
    valid_rows,
)
from starflow.operators.reshape import (
    copy_column,
    project,
    rename,
    strict_rows,
    unnest,
    zip_arrays,
)

__all__ = [
    "aligned_join", "any_per_key", "append_new", "asof_join", "checked", "conform", "copy_column",
    "dense_key", "fk_orphans", "hash_key", "insert_keyed", "latest_per_key",
    "left_enrich", "lookup", "misfits", "new_rows", "next_key", "observed", "only_latest", "pk_violations", "project",
    "quarantined_rows", "rename", "strict_rows", "unnest", "upsert", "valid_rows", "version_changes",
    "write_clustered", "zip_arrays",
]
