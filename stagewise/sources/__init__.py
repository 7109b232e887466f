"""Sources: raw JSON-lines zone readers, test-table adapters, raw-zone inventory."""
