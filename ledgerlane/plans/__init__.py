"""Wiring of the models: which feeds what, which checks guard them, and publishing."""
