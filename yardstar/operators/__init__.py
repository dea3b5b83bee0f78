"""Conforming, keys, dimensions, facts, snapshot and audits."""
