"""Daily station-weather ETL, validation and profiling as Spark plans."""
