"""Operations on text corpora: scoring, near duplicates, archives, mixing, sharding, token counts."""

import sys

from pyspark import cloudpickle

# Tasks get these modules' functions by value, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
