"""Scans and sinks: raw CSV, archives, Bronze, control log, path manifests, table registration."""
