"""tidewater: stream and batch data operators on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark
SQL / DataFrame primitives; those that need per-key order or state have a
batch form (windows, two-level scans) and a Structured Streaming form.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions and classes of this package that run inside Spark tasks
    (pandas folds, lookups, state processors) are pickled by value, so
    Python workers do not need the package on their path."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pyspark missing or an older cloudpickle: by reference
        pass


_ship_by_value()
