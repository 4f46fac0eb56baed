"""ringspan: DataFrame operators for call-quality, tabular, embedding and text data."""

import sys

from pyspark import cloudpickle

# Task functions travel inside the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
