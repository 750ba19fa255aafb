"""Scans and sinks of the file formats the operators read and write."""
