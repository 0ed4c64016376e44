"""Importing this module registers every check."""

from checks import document_checks, metric_checks, path_checks, sales_checks, source_checks, sql_answer_checks  # noqa: F401
from checks.registry import ORACLES, QUERIES  # noqa: F401
