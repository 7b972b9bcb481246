"""quarry: content ingestion and retrieval as Spark jobs."""

import sys as _sys

try:  # ship this package's UDF code to the Python workers by value
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: workers need the package on their path
    pass

__version__ = "0.1.0"
