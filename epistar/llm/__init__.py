"""Training-data operators and their queries (see README, section on the llm subpackage).

Functions that run inside tasks are shipped to the executors by value, so a
cluster needs no installed copy of this subpackage beyond numpy and pyarrow.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
