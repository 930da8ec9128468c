"""anchorwise: Spark-native point-in-time features, rule scoring and quota selection.

Every operator takes and returns a DataFrame; the work runs as Spark plans
(joins, windows, aggregates), never as a driver loop.
"""

__version__ = "0.1.0"
