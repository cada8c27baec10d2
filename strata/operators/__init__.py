"""Silver binding, catalog tables, gold SQL, data-quality checks, run ledger."""
