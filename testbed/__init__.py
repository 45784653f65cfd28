"""The driver's tables seen as a ledger, with an independent SQL oracle."""
