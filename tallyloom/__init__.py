"""Ledger reconciliation and repayment analytics as Spark DataFrame jobs."""
