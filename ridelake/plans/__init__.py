"""The layer run, the registered queries and their SQL counterparts."""
