"""countwise: word statistics, triangle counting and stream frequency
statistics written as plain PySpark DataFrame / Structured Streaming code.

Subpackages
-----------
sources    readers for text, edge lists, item streams and the driver tables
functions  column expressions: linear hashes, tokenising, integer medians
operators  DataFrame -> DataFrame operators (words, triangles, frequency)
plans      one-row reports and the catalogue of registered queries
streaming  Structured Streaming versions of the frequency statistics
"""

from countwise.session import checkpoint_root, local_session, scratch_path

__all__ = ["checkpoint_root", "local_session", "scratch_path"]
