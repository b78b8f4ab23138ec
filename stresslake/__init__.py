"""Stress testing over a layered data lake, as plain Spark DataFrame operators."""

from stresslake.specs import SPECS, Layout, TableSpec, spec_for

__all__ = ["SPECS", "Layout", "TableSpec", "spec_for"]
