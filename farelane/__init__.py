"""farelane: trip demand and fare analytics as PySpark DataFrame functions."""

import sys as _sys

__version__ = "0.1.0"

# Functions shipped to Python workers (Arrow-batched scoring, per-bucket
# solves) are pickled with the library code they use, so executors need no
# installed copy of the package.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: install the package on executors
    pass
