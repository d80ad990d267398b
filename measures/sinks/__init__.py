"""Table writes: facts, dimensions, enrollments, roll-up and ledger."""
