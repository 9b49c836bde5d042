"""Dataset-quality engine for clip, frame, manifest and log tables on Spark."""

import sys

from pyspark import cloudpickle

from clipwarden.session import build_session
from clipwarden.spec import CLIP_COLUMNS, GradeThresholds, TargetSpec

__all__ = ["CLIP_COLUMNS", "GradeThresholds", "TargetSpec", "build_session"]

# kernels travel to the executors with their code: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
