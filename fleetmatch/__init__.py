"""fleetmatch: reconcile two device inventories with Spark.

Read delimited exports, normalise and de-duplicate them, keep each inventory as
a versioned snapshot, match both by hostname and report which devices are
covered by both systems or by only one.
"""
