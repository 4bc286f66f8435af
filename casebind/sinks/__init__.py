"""Where results go: ledger appends, review and roster files, form updates."""
