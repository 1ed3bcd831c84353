"""Send helper functions to the workers by value, so that executors need no copy of this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module])
