"""Operators of a training-data pipeline over `documents`, `pages`, `embeddings` and `conversations`.

Nothing outside this folder, `corpus_pipeline.py` and `tests/llm` imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors by value, so that those need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
