"""Value types, scalar expressions and storage helpers."""
