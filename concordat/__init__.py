"""Spark-first entity resolution: blocking, retrieval, pairwise features, scoring, routing, evaluation."""

import sys

from pyspark import cloudpickle

# Python code that Spark runs on executors travels by value: a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
