"""Market-research data engine: keyed tables, article text, embeddings and grounded
research contexts, every operation expressed as a whole-table Spark job."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
