"""shelfwise: retail and operations analytics as Spark DataFrame operators.

Every public operator is a function from DataFrames (plus plain Python
parameters) to a lazy DataFrame built from native Spark expressions, windows,
joins and aggregates.  Nothing is collected to the driver except small control
summaries that callers explicitly ask for.
"""

__version__ = "0.1.0"
