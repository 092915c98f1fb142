"""Whole loads: which operator runs on which stored table, in which order."""
