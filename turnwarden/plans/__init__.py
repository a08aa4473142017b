"""Ordered rule stacks, verdicts, audit tables and analytics."""
