"""Reconciliation: every operator run on the driver's tables, next to the SQL it must agree with."""
