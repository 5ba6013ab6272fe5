from .ddl import ddl_to_actions, parse_ddl
from .debezium import debezium_to_changes, invalid_events, parse_debezium
from .schema import infer_specs, map_source_columns, read_metadata, select_tables, spec_rows, target_name
from .sync import sync_batch, sync_database, target_map
from .start import Position, load_snapshot
