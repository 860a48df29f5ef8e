"""silkmill: a Spark-native engine for document, dialogue and tool-call data preparation."""

import os as _os
import sys as _sys
from pathlib import Path as _Path

from pyspark import cloudpickle as _cloudpickle

# Python workers inherit PYTHONPATH but not sys.path: where the package is not on it, its functions travel by value.
if str(_Path(__file__).resolve().parent.parent) not in _os.environ.get("PYTHONPATH", "").split(_os.pathsep):
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
