"""Operators put together: training, prediction, profiles, experiments."""
