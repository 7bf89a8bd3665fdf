"""quotewell: daily market-data and customer-mart jobs as Spark DataFrames.

Sub-packages
    functions   column expressions (times, keys, code maps, arrays, numbers)
    operators   DataFrame -> DataFrame steps (rules, cleaning, ordered scans, ...)
    sources     schemas, readers, partition upkeep and table sinks
    plans       whole jobs: publish, reconcile, daily chain, customer marts
    streaming   file-arrival ingest
"""
