"""Importing this module registers every query."""

from workload import (  # noqa: F401
    catalogue_queries,
    draft_queries,
    envelope_queries,
    function_queries,
    history_queries,
    merge_queries,
)
