"""Governance tables on Spark: landing, consolidation, inventory, reconciliation."""
