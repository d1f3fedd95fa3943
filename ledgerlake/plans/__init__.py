"""Whole jobs: Bronze to Silver, Silver to Gold, validation, and measurements."""
