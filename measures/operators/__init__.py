"""Validation, constraints, dimensions, roll-up and ledger operators."""
