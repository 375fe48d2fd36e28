"""Operations on training text: scoring, filtering, matching, scanning and writing."""

import sys

from pyspark import cloudpickle

# Python workers get the functions themselves, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
