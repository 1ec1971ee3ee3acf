"""Query of document fingerprints."""

from lectern.llm.registry import query
from lectern.llm.syncmers import edited


@query("op9_closed_syncmers")
def op9_closed_syncmers(table):
    return edited(table("documents"))
