"""faultline — Spark-native analytics for device telemetry and flash-offer sales.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from Catalyst
expressions, window functions and aggregates.  Sub-packages:

* ``sources``   — table readers, fixture views, loaders and sinks (A*)
* ``functions`` — shared column expressions (null/inf-safe division, correlation, ...)
* ``operators`` — offer features and KPIs (B, D), statistics (E), device features (F),
                  labels/splits/sampling (G), ranking (H), model jobs (I), thresholds (K),
                  event matching and business metrics (C, J)
* ``plans``     — compositions of operators (distributed prefix sums, the device model run)
* ``streaming`` — micro-batch adapters (the source library has no streaming semantics)
"""

__version__ = "0.1.0"
