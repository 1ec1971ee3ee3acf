"""Query of personal data."""

from lectern.llm.pii import find
from lectern.llm.registry import query


@query("op10_pii_disclosure")
def op10_pii_disclosure(table):
    return find(table("documents"))
