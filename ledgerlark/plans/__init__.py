"""Registered queries. Importing this package registers all of them."""

from ledgerlark.plans import calendars, files, portfolio, prices, reports, streams  # noqa: F401
from ledgerlark.plans.registry import ORACLES, QUERIES  # noqa: F401
