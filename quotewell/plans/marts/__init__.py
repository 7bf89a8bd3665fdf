"""Customer marts. Each is a function (tables, run day) -> DataFrame, where
``tables`` maps input names to DataFrames with DATE columns. Writing the result
is the caller's: ``sinks.replace_partition(df, path, "data_dt")``."""
