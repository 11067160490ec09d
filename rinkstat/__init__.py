"""rinkstat: sports-league statistics as plain Spark DataFrame transformations.

Every public operator is a ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function.  The library never creates a SparkSession, never collects data to the
driver and never loops over rows in Python; the caller owns the session.
"""

__version__ = "0.1.0"
