"""All registered queries; importing the modules fills the registry."""

from millrace.plans import learning, monitoring, tabular  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES  # noqa: F401
