"""Table scans, lookup joins, change-log loads and database synchronisation on Spark DataFrames and streams."""

from .spec import OP, ColumnSpec, TableSpec, column_list, is_aligned, validate
from .types import source_type, spark_type, table_type
from .operators import *
from .sources import *
from .functions import *
from .plans import *
from .store import *
from .streaming import *
from .cdc import *
