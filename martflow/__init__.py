"""martflow: a layered sales warehouse (staging -> silver -> gold) on Spark.

Every model is a function ``DataFrame(s) -> DataFrame`` so that the same code
serves batch builds, ``foreachBatch`` stream sinks and tests.  Catalyst plans
all of it; there are no Python UDFs.
"""

from martflow.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
