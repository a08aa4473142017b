"""Screening, access, lookup and scoring operators."""
