"""Column expressions and small per-task helpers."""
