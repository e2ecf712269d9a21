"""Training-data operators (thirteen, one module each) and their registered queries.

Nothing outside this package imports it.  Every operator takes and returns
DataFrames; Python runs only inside Arrow/pandas tasks that Spark partitions.
"""
