"""Registered queries: each operator run over the driver's tables, with equivalent SQL beside it."""
