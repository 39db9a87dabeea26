"""Schemas, readers, writers and the binding of the test tables to the model."""
