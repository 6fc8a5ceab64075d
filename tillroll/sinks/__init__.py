"""Writers: the cleansed table and the ledger."""
