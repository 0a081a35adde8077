"""All registered queries; importing the modules registers them."""

from workload import sqlparts  # noqa: F401
from workload import q_sources  # noqa: F401
from workload import q_relational  # noqa: F401
from workload import q_features  # noqa: F401
from workload import q_assignment  # noqa: F401
from workload import q_grouping  # noqa: F401
from workload.registry import ORACLES, QUERIES  # noqa: F401
