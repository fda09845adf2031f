"""Whole jobs: the star, its reports and the ingestion that feeds it."""
