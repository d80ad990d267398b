"""Query plans: analytics (Q1-Q7), readers (R1-R4), the batch load, the registered catalog."""
