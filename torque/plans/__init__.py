"""Whole jobs: the ETL and ELT flows and their reconciliation."""
