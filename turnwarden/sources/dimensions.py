"""Dimension tables: users, permissions, term and pattern lists, rules, knowledge base, records, articles.

Each is a small fixed list here and a ``DataFrame`` to the operators, so a job can pass its own table instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from turnwarden import fixed_values as fixed


def table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of literal rows, planned as a local relation."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def users(spark: SparkSession) -> DataFrame:
    return table(spark, fixed.USERS, "user_id string, role string")


def role_permissions(spark: SparkSession) -> DataFrame:
    rows = [(role, tool) for role, tools in fixed.ROLE_TOOLS.items() for tool in tools]
    return table(spark, rows, "role string, tool_name string")


def terms(spark: SparkSession) -> DataFrame:
    lists = {"banned": fixed.BANNED_KEYWORDS, "competitor": fixed.COMPETITORS, "marker": fixed.LEAK_MARKERS,
             "crisis": fixed.CRISIS_SIGNALS, "profanity": fixed.PROFANITY_STEMS, "doctor": fixed.DOCTORS,
             "domain": fixed.TRUSTED_DOMAINS, "injection_phrase": fixed.INJECTION_PHRASES}
    rows = [(name, i, term) for name, items in lists.items() for i, term in enumerate(items)]
    return table(spark, rows, "list_name string, ord int, term string")


def patterns(spark: SparkSession) -> DataFrame:
    rows = [(2, i, p, p) for i, p in enumerate(fixed.INJECTION_PATTERNS)]
    rows += [(25, i, p, p) for i, p in enumerate(fixed.INDIRECT_PATTERNS)]
    rows += [(28, i, p, p) for i, p in enumerate(fixed.DANGEROUS_CODE_PATTERNS)]
    rows += [(27, i, n, p) for i, (n, p) in enumerate(fixed.OUTPUT_PII_PATTERNS)]
    rows += [(5, i, n, p) for i, (n, p) in enumerate(fixed.INPUT_PII_PATTERNS)]
    rows += [(6, i, n, p) for i, (n, p) in enumerate(fixed.CUSTOM_PII_PATTERNS)]
    rows += [(20, i, n, p) for i, (n, p) in enumerate(fixed.SECRET_PATTERNS)]
    return table(spark, rows, "rule int, ord int, label string, regex string")


def rules(spark: SparkSession) -> DataFrame:
    return table(spark, fixed.RULES, "number int, name string, stage string")


def knowledge_base(spark: SparkSession) -> DataFrame:
    rows = [(i, topic, text) for i, (topic, text) in enumerate(fixed.KNOWLEDGE_BASE)]
    return table(spark, rows, "ord int, topic string, text string")


def patient_records(spark: SparkSession) -> DataFrame:
    return table(spark, fixed.PATIENT_RECORDS, "patient_id string, text string")


def articles(spark: SparkSession) -> DataFrame:
    rows = [(i, domain, text) for i, (domain, text) in enumerate(fixed.ARTICLES)]
    return table(spark, rows, "ord int, domain string, text string")


def appointments(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, *r) for i, r in enumerate(fixed.APPOINTMENTS)]
    return table(spark, rows, "id long, patient string, doctor string, date string, status string")
