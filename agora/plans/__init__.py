"""Composite jobs (ingest, staging, weekly reports, moderation) and the query catalog."""
