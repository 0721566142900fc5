"""Row-set operators: plain DataFrame in, DataFrame out."""

from strata.operators.bucketed import left_join_bucketed, merge_bucketed, write_bucketed
from strata.operators.by_file import recover_by_file, upsert_by_file, write_clustered
from strata.operators.conform import (add_column_at, cast_by_mapping, conform_to_schema,
                                      fill_nulls, project_to_target, rename_by_mapping,
                                      select_alias, with_audit)
from strata.operators.dedupe import dedupe_any, dedupe_ends, dedupe_latest
from strata.operators.joins import broadcast_if_small, left_join_fanout, left_join_unique
from strata.operators.keys import stable_keys, surrogate_key
from strata.operators.load import (append, full_reload, upsert, upsert_actions, upsert_counts,
                                   write_table)
from strata.operators.partitioned import recover_partitioned, upsert_partitioned

__all__ = [
    "add_column_at", "cast_by_mapping", "conform_to_schema", "fill_nulls",
    "project_to_target", "rename_by_mapping", "select_alias", "with_audit",
    "dedupe_any", "dedupe_ends", "dedupe_latest", "broadcast_if_small", "left_join_fanout",
    "left_join_unique", "stable_keys", "surrogate_key",
    "append", "full_reload", "upsert", "upsert_actions",
    "upsert_by_file", "upsert_counts", "upsert_partitioned", "write_table",
    "left_join_bucketed", "merge_bucketed", "write_bucketed", "recover_by_file", "recover_partitioned", "write_clustered",
]
