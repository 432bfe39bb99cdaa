"""Load, history and reconciliation of an operational data store on Spark."""
