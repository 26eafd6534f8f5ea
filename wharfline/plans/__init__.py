"""Whole analyses: dashboard queries, the curation job, and the registered queries with their SQL."""
