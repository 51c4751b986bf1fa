"""Operators for training data: tokens, toxicity, chat, packing, private data, search, near copies, archives."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: what tasks run travels with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
