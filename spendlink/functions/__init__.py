"""Column expressions: cleaning, text forms, similarity, concept answers, tags."""

import sys

from pyspark import cloudpickle

# UDF code travels inside the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
