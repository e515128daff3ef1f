"""changeflow: change-data and event-stream ingestion expressed as Spark DataFrames.

Every operator is a plain function from DataFrames to a DataFrame, so batch and
streaming callers share the same logical plans and Catalyst sees all of them.
"""
