"""Corpus operators for training-data pipelines.

Each module is one operator with its own interface; ``catalog`` registers the
thin ``opN_<name>`` queries over a table directory. Nothing else in the
library imports this subpackage.

Functions that run inside tasks are shipped to the executors by value with the
objects they hold, so a worker needs the third-party libraries but no installed
copy of this package. Broadcasts are pickled by reference to their classes, so
they hold arrays, dicts and tuples only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
