"""Streams of rows through a fixed generalisation."""
