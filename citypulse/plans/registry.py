"""Imports every query module so the catalog is complete."""

from citypulse.plans import queries_ecology  # noqa: F401
from citypulse.plans import queries_mobility  # noqa: F401
from citypulse.plans import queries_safety  # noqa: F401
from citypulse.plans import queries_metrics  # noqa: F401
from citypulse.plans import queries_timeseries  # noqa: F401
from citypulse.plans import queries_models  # noqa: F401
from citypulse.plans import queries_bi  # noqa: F401
from citypulse.plans import queries_checked  # noqa: F401
from citypulse.plans import queries_artifacts  # noqa: F401
