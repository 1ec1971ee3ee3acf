"""All registered queries."""

from lectern.plans import q_catalogue, q_cleaning, q_matching, q_records, q_rules, q_wide  # noqa: F401
from lectern.plans.registry import QUERIES, SQL  # noqa: F401
