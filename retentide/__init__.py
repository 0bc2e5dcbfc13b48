"""User-lifecycle analytics over an application event log, on Spark."""
