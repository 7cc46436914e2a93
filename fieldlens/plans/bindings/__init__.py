"""Operators bound to the given tables, each with the SQL that states its expected result."""

from fieldlens.plans.bindings.registry import ORACLES, QUERIES  # noqa: F401
from fieldlens.plans.bindings import layer_queries, source_queries, text_queries  # noqa: F401
from fieldlens.plans.bindings import line_queries, stream_queries  # noqa: F401
from fieldlens.plans.bindings import coverage_queries, geo_queries, report_queries, rule_queries, second_queries  # noqa: F401
