"""movegrid: Spark-native movement, grid and catch analytics.

Every operator is a plain, lazy ``DataFrame -> DataFrame`` function.  Nothing in
the operators triggers a Spark action except where an exact result needs a
checkpoint to freeze an intermediate (see ``functions.ordering``).
"""

__version__ = "0.1.0"
