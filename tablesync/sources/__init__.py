from .export import frame_chunks, write_text
from .records import custom_records, address_records, decode, decode_text, map_records
from .scan import observe_scan, scan, scan_count, scan_options
