"""DataFrame operators: pages, lines, classification, identities, snapshots, reconciliation, quality checks."""
