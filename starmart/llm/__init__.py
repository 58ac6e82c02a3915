"""Training-data operators: fingerprints, quality, URL rules, mixing, secrets,
near duplicates, decontamination, repeated passages, language, repeated lines.

Functions of this subpackage travel to Python workers by value, so workers need
numpy and pyarrow, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
