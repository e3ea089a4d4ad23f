"""Operators for preparing training text at scale. Nothing else in the library
imports this subpackage.

The functions that run in tasks are sent to the executors as they are, with what
they capture, so that executors need no copy of this library on their path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["gaugeline"])
