"""DataFrame -> DataFrame operators (splits, filters, statistics, models,
top-K, metrics and analyses)."""
