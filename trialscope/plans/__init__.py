"""Composite jobs: the whole report set over one as-of date."""

from .reports import TrialReports  # noqa: F401
