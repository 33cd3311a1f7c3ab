"""spindle: word, key and stream statistics as Spark DataFrame / Structured Streaming jobs.

Every public operator takes DataFrames (or a session plus paths) and returns a
DataFrame.  What reaches the driver is bounded: probes of one row, counts per group of
partitions, model parameters; never the rows of a table.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions and classes by value.

    Python workers (mapInArrow, Pandas UDFs) then rebuild the functions from the
    task itself, so executors need no copy of the package on their path.
    """
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
