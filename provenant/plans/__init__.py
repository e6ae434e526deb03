"""Importing this package registers every query."""

from provenant.plans import audits, catalogue, mechanisms  # noqa: F401
