"""Market-data lake jobs on Spark: clean, merge, audit, enrich and report price series."""
