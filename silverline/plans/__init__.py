"""Whole jobs: bronze ingestion, silver transforms, consolidation, typed export."""
