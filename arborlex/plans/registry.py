"""All registered queries and their SQL."""

from arborlex.plans.oracles import ORACLES as _SQL
from arborlex.plans.queries import QUERIES

ORACLES = {k: v for k, v in _SQL.items() if k in QUERIES}
# what one epoch proposes is what the rule for proposals gives
ORACLES["discover_epoch"] = _SQL["proposal_groups"]
