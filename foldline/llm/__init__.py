"""Training-data operators (mixing, sharding, extraction, PII, WARC, decontamination,
language-model scoring, quality rules, n-gram joins, token files) as Spark jobs.

Functions of this package that run inside tasks travel by value, so executors need the
third-party libraries only, not this package on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
