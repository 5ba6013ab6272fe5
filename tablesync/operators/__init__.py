from .bloom import KeyFilter
from .builders import LoadColumns, aggregate_values, sketch_table
from .changes import append, apply_changes, expand_updates, filter_kinds, fold, merge, to_op
from .columns import map_columns, sketch_columns, split_mapping
from .lookup import CachedDimension, heavy_join, heavy_keys, lookup_by_keys, lookup_join
from .quality import LoadRejected, check_rows, conform, gate, load_report, split_valid
from .sketches import bitmap_merge, bitmap_ndv, bitmap_rollup, hll_merge, hll_ndv, hll_rollup, mixed_merge, mixed_ndv, mixed_rollup
