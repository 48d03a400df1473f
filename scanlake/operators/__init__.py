"""DataFrame operators: findings, documents, coordination, monitoring, search."""
