"""wellspark: health time series, star schema, quality checks and A/B statistics on Spark."""
