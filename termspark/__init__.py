"""termspark: terminology mapping on Spark.

Concept search documents, concept statistics, terminology import/export,
table maintenance, text analysis and batch concept retrieval, all written
as DataFrame / Spark SQL jobs.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions that run in tasks travel by value: workers need not have the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
