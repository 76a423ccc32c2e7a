"""Part of kinweave."""
