"""Training-data operators: licence scans, packing, near-dedup, secret scans, token rollups,
sharding, exact top-k search, decontamination, language-model scoring, quality scoring,
cross-tokenizer alignment, toxicity, spelling variants.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
