"""Relational operators of the ELT: parse, rates, merge, bridge, marts, serve, dashboards, quality."""
