"""Registered queries with their SQL equivalents."""

from turnwarden.queries import input_stage, output_stage, tool_stage, lookups, composed, audit, models, streams, tables, turn  # noqa: F401
from turnwarden.queries.common import ORACLE, QUERIES  # noqa: F401
