"""Spark-native data engine for tool-calling fine-tuning and distillation."""

import sys

from pyspark import cloudpickle

from distaff.session import checkpoint_dir, configure, materialise, scratch_path

# Batch functions travel with their job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["checkpoint_dir", "configure", "materialise", "scratch_path"]
