"""quire: company disclosures, document pages and financial tables as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job; nothing is installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
