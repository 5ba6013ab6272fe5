from .encode import encode_csv, encode_json, nested_to_load, normalize_for_load, parse_delimiter, to_json_column
from .redact import redact, redact_column
from .temporal import format_temporals, temporal_text
