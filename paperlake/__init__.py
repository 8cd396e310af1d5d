"""paperlake: a PySpark lakehouse for scholarly-paper metadata with cosine search."""

import sys

from pyspark import cloudpickle

from paperlake.session import build_session
from paperlake.settings import LakeSettings, Source

__all__ = ["LakeSettings", "Source", "build_session"]

# Functions of this package travel to the Python workers by value, so executors
# need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
