"""Field-activity analytics on Spark: calls, planning cycles, lookups, additive flags."""
