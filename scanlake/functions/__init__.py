"""Column functions: text labels, paths, nested findings, secret rules."""
