"""Sources: incremental file folders, the changed-file ledger and paged REST APIs."""
