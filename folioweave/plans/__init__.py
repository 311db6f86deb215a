"""Whole jobs: one parameterised plan per subject, one configuration row per generation."""
