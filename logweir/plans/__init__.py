"""Table specs and their compilation to column expressions."""
