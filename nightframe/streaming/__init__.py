"""Incremental runs of the refresh jobs as Structured Streaming queries."""
