"""Configured plans: preprocessing, model pipelines, experiment groups."""
