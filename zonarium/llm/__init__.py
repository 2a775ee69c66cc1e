"""Operators of a training-data pipeline for language models.

Nothing else in the library imports this subpackage; the registered queries are
in ``queries``.  What tasks call is sent to them with the job, so executors need
the libraries, but not this package, on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
