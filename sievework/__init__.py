"""Content checks, reference reconciliation and record routing on Spark."""
