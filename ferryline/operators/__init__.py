"""DataFrame-to-DataFrame operators."""

from ferryline.operators.filters import (
    drop_control_rows,
    drop_nulls,
    is_control_row,
    key_equals,
    optional_time_range,
    resolve_column,
    time_range,
)
from ferryline.operators.keyed import (
    apply_changes,
    batch_counts,
    delete_insert,
    first_row,
    latest_changes,
    latest_per_key,
    merge_few,
    merge_ordered,
    order_key,
    partition_by_key,
    upsert,
)
from ferryline.operators.lookups import (
    first_child,
    lookup_chain,
    new_keys_only,
    parent_children,
)
from ferryline.operators.project import (
    cast_columns,
    chain,
    explode_children,
    map_columns,
    rename_by_position,
    stamp,
    struct_rows,
    union_all,
)

__all__ = [
    "apply_changes",
    "batch_counts",
    "cast_columns",
    "chain",
    "delete_insert",
    "drop_control_rows",
    "drop_nulls",
    "explode_children",
    "first_child",
    "first_row",
    "is_control_row",
    "key_equals",
    "latest_changes",
    "latest_per_key",
    "lookup_chain",
    "map_columns",
    "merge_few",
    "merge_ordered",
    "new_keys_only",
    "optional_time_range",
    "order_key",
    "parent_children",
    "partition_by_key",
    "rename_by_position",
    "resolve_column",
    "stamp",
    "struct_rows",
    "time_range",
    "union_all",
    "upsert",
]
