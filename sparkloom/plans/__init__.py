"""Registered queries: operators applied to the driver's tables, with equivalent SQL."""
