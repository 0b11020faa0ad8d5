"""Column expressions and small helpers for tasks."""
