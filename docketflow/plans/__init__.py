"""Bindings of tables to the model, and the registered queries with their SQL."""
