"""Operators of a training-data pipeline.

Nothing outside this subpackage imports it.  Functions that run inside Spark tasks
are importable by name, so the package has to be on the executors' Python path
(``--py-files``, or installed there).
"""
