"""Spark-first analytics: funnels, event monitoring, retrieval, clustering, loading, linked notes.

Every operator is a plain function from DataFrame to DataFrame, for use with
``df.transform``. See README.md for the map of modules.
"""

__version__ = "0.1.0"
