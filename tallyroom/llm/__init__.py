"""Operations on training corpora: filters, dedup, mixing, tokens, archives, search."""

import sys

from pyspark import cloudpickle

# Tasks carry the code of these modules with them, so executors need no copy installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
