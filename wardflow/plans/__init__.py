"""The whole run, and the registered queries with their SQL counterparts."""
