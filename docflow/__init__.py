"""docflow: document processing on open Apache Spark.

Ingest, parse, flatten, enrich, check and publish documents with DataFrame,
SQL and Structured Streaming operators.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
