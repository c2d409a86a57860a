"""Change-history analytics on Spark.

Everything here takes and returns DataFrames. Plans are lazy unless their
docstring says that they write; writers live in ``sources`` and ``streaming``.
"""
