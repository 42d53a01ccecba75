"""tidemill: incremental scanning of changing text records, expressed as Spark DataFrames."""
