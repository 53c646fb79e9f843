"""Spark-native review moderation: cleaning, labeling rules, weak labels, text features, training, evaluation."""

import sys as _sys

try:
    # Ship this package's code inside pickled UDFs (pandas UDFs, applyInPandas)
    # so executors need no installed copy of it.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pickler without the hook
    pass
