"""Identifiers, manifests, summaries and lineage events as rows."""
