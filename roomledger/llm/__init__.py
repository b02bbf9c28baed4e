"""Training-data operators: packing, piece sampling, quality rules, language-model scores, fingerprints,
personal data, quality and toxicity classifiers, near-duplicate and repeated-line removal.

Functions that run in Python workers are pickled by value, so executors need numpy and pyarrow but not
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
