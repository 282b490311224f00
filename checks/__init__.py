"""The given tables seen as an order export, the registered queries, and their SQL counterparts."""
