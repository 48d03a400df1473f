"""Registered queries over the given tables, by theme."""

from scanlake.plans.coordination import COORDINATION
from scanlake.plans.findings import FINDINGS
from scanlake.plans.monitoring import MONITORING
from scanlake.plans.records import RECORDS
from scanlake.plans.search import SEARCH
from scanlake.plans.streams import STREAMS

QUERIES = {**RECORDS, **FINDINGS, **COORDINATION, **MONITORING, **SEARCH, **STREAMS}
