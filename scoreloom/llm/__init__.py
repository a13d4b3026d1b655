"""Operators for preparing training corpora; nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the tasks, so a cluster
# needs no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
