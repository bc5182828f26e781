"""Incremental forms of the batch operators (log shipping while jobs run)."""
