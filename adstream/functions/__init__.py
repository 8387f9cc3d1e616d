"""Column expressions: fraud rules and event-time arithmetic."""
