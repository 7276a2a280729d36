"""Market time series on Spark: bar tables, quality checks, indicators, VWAP, measures, retrieval."""
