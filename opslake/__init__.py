"""opslake — order-lifecycle analytics on Spark DataFrames.

Layers: sources (landing, stamps, checksums) -> operators (proofs, contracts,
calibration, lifecycle, marts, journeys) -> plans (layer writes, breaker,
manifest). Every operator is a pure ``DataFrame -> DataFrame`` function built
from Spark's built-in expressions, so Catalyst can prune, push down and
codegen the whole chain.
"""

__version__ = "0.1.0"
