"""tablesync: copy relational schemas and keep document collections in step
with columnar targets, expressed as Spark DataFrame plans.

Layout
------
functions/   Column -> Column building blocks (names, times, text, sizing)
operators/   DataFrame -> DataFrame steps (coerce, documents, routing, upsert, ...)
sources/     catalogue, relational (JDBC / file) tables, paged documents
plans/       the acting layer: versioned sinks and the composite jobs
streaming/   the incremental job driven by a file stream (foreachBatch)
"""

__version__ = "0.1.0"

# Python workers may not see the package on their path (the driver can add
# it to sys.path at run time), so functions and data sources defined here are
# shipped to tasks by value rather than by module reference.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
