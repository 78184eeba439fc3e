"""End-to-end flows, the registered queries and their SQL oracles."""
