"""Patient-evidence and multimodal feature datasets as Spark DataFrame operators.

Sub-packages:

``functions``  column expressions and the two shared scale primitives (exact
               percentiles / running totals, and skew-proof lookups)
``sources``    readers, inventories, binary decoding and sinks
``operators``  DataFrame-to-DataFrame operators
``plans``      composite jobs and the registered queries
``streaming``  incremental loading with the file source
"""

__version__ = "0.1.0"
