"""Composite jobs: history migration, upload validation, recurring load,
publishing to a model store, and the four jobs run against a store."""
