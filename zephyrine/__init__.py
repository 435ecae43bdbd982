"""Air-quality time-series features, profiling and forecasts on Spark."""
