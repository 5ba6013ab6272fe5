from .apply import admission, start_position, start_query, stream_apply
from .cache import KeyCache
from .listener import LoadListener
from .lookup import stream_lookup_join
from .parts import load_in_parts
from .reports import LoadReports
from .route import route, route_batch
