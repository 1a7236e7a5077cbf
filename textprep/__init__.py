"""Spark jobs that prepare, audit, vectorise, score and compare labelled text."""

import sys

from pyspark import cloudpickle

from textprep.config import PrepConfig, SequenceConfig, TfidfConfig

# Functions used inside tasks travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["PrepConfig", "SequenceConfig", "TfidfConfig"]
