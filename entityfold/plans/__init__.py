"""The business-register build: configuration and plans on top of the generic operators."""
