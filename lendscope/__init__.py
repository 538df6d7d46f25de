"""lendscope: peer-to-peer loan-book risk analytics on Spark.

Sub-packages
------------
sources    readers, writers and the text scrub job; the loan-shaped test view
functions  column expressions (parsing, labels, missing-value tests)
operators  DataFrame -> DataFrame operators (quality, exploration, distributions,
           features, clustering, models, metrics)
plans      end-to-end cleaning plans and the registered query catalogue
streaming  the row-level cleaning rules on a Structured Streaming source
"""

from lendscope.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
