"""The engine's queries on the driver's tables, each with its SQL counterpart."""
