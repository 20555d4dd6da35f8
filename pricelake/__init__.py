"""pricelake: a PySpark-native engine for daily price series.

Every operator is a lazy ``DataFrame -> DataFrame`` transformation keyed by
``symbol`` (one series or millions of them), built from Spark SQL built-ins so
Catalyst can prune, push down and code-generate the whole plan.
"""

__version__ = "0.1.0"
