"""Job plans: config lookup, the four file-drop jobs, the paged-API CDC job and
the audit log."""
