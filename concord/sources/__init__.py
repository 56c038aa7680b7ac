"""Sources and sinks: tables, file listings, commit logs, manifests, the ledger."""
