"""Whole runs that string operators together."""
