"""Building-damage analytics over satellite time series, as Spark DataFrame jobs."""
