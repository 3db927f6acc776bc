"""Delimited and JSON feed files in, layered tables out."""
