"""Operators for preparing training data: near duplicates, sharding, fingerprints, mixing, language, privacy, tokens."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with their code: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
