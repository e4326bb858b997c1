"""All registered core queries."""

from __future__ import annotations

from sitewright.plans import event_queries, flow_queries, problems, site_queries

flagship = event_queries.site_pipeline


def modules() -> list:
    return [event_queries, site_queries, flow_queries, problems]
