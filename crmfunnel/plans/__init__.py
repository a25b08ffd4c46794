"""Prep views, facts, dimensions, reports, measures, checks and audits."""
