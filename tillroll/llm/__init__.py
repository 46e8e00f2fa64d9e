"""Operators for preparing training text: duplicates, filters, counts, archives and mixing.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries only where the subpackage is present.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
