"""Compositions of operators: layer pipelines, domain views, registered queries."""
