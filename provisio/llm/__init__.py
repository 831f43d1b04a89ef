"""Operators of a training-data pipeline (decontamination, classifiers, packing,
chat formatting, deduplication, licence scans), one module each.

Nothing else in the library imports this subpackage."""
