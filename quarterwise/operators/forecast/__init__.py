"""Forecasts of every series at once: closed-form models, pooled learners, selection."""
