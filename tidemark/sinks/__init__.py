"""Target tables, ledgers and table maintenance."""
