"""List import, record matching and list preparation on Spark."""

from rollcall.operators.geo_tiers import flatten_tiers, tier_summary
from rollcall.operators.matching import MatchRules, address_score, match_people, name_score
from rollcall.sources.delimited import import_list

__all__ = [
    "MatchRules",
    "address_score",
    "flatten_tiers",
    "import_list",
    "match_people",
    "name_score",
    "tier_summary",
]
