"""starloom: a three-layer (bronze / silver / gold) sales warehouse on PySpark.

Every operator is a plain function DataFrame -> DataFrame built from the
DataFrame API, so Catalyst plans it and the work runs on the executors.
I/O lives at the edges (``starloom.sources``); the build order lives in
``starloom.plans``.
"""

__version__ = "0.1.0"
