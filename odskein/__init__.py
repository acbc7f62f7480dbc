"""Origin/destination flow analytics as Spark DataFrame transformations.

Every operator takes DataFrames and returns DataFrames built from Spark's own expressions, so
the whole chain from scan to sink is one plan for Catalyst. Nothing here runs a Python UDF.
"""
