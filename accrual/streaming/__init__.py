"""Continuous loading of topics into layer tables."""
