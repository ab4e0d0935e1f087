"""Training-data operators and the corpus pipeline.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its queries only
when it can be imported. Functions that run in tasks are shipped by value, so executors
need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
