"""Sluice: config-driven onboarding and incremental fetch, written as Spark jobs."""
