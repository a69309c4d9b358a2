"""Presets for basketball tables: operators bound to column names and rules."""
