"""Inputs: landing-file scans, the stored tables, and the driver-table adapter."""
