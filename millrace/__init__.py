"""Layered real-time warehouse operators for an online shop, on Spark.

Every operator takes DataFrames and returns a DataFrame.  ``operators`` holds
the batch forms, ``streaming`` the Structured Streaming forms of the stateful
ones; stateless operators work unchanged on both.
"""

__version__ = "0.1.0"
