"""The registered queries, their SQL counterparts, and the inputs both are built from."""
