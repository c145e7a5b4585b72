"""voltaflow: renewable-power telemetry analytics as Spark DataFrame operators.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Catalyst expressions so that predicate pushdown, column pruning, partial
aggregation and whole-stage codegen apply.  The only Python kernel is the
battery state-of-charge recurrence (``operators.dispatch``), which is a
serial fold per battery and runs as a sorted ``mapInArrow`` stream.
"""

__version__ = "0.1.0"

# Ship our functions to Python workers by value, so executors need no
# installed copy of the package (works for local and cluster deployments).
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
