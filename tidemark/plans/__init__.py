"""The steps of a run: mirror, staging, model, reports."""
