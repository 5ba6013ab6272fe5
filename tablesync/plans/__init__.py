from .pushdown import pushed_filters, read_columns, shuffles, split_filters
