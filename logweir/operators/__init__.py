"""Batch operators: extraction, sinks, inference, evolution, retention and the run ledger."""
