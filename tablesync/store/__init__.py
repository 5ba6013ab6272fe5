from .registry import Registry
from .rejects import Rejects
from .table import ConcurrentCommit, KeyedTable
