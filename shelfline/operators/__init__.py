from shelfline.operators.bitmaps import distinct_counts, distinct_state, merged_states
from shelfline.operators.history import scd2_merge, scd2_merge_in_place, versions_at
from shelfline.operators.quality import (
    copy_dimension,
    distinct_rows,
    duplicate_key_counts,
    empty_like,
    null_counts,
    require_unique,
)
from shelfline.operators.refresh import (
    high_water,
    incremental_refresh,
    mark_of,
    read_mark,
    rows_from,
    rows_kept,
)

__all__ = [
    "copy_dimension",
    "distinct_counts",
    "distinct_rows",
    "distinct_state",
    "duplicate_key_counts",
    "empty_like",
    "high_water",
    "incremental_refresh",
    "mark_of",
    "merged_states",
    "null_counts",
    "read_mark",
    "require_unique",
    "rows_from",
    "rows_kept",
    "scd2_merge",
    "scd2_merge_in_place",
    "versions_at",
]
