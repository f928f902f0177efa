"""Operators of a training-data pipeline: line and near-duplicate removal, archives, token counts, scans, filters, mixing."""
