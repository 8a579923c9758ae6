"""De-duplication, load operators, versioned targets and the run ledger."""
