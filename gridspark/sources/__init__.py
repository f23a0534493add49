"""Landed raw files to typed rows."""
