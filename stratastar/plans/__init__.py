"""Declarative layers: silver tables, gold star, semantic model, security."""
