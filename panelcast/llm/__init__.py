"""Operations of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` registers its
queries when it is present. Its functions travel to Python workers by value, so the workers need
not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
