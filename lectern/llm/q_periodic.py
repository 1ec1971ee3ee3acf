"""Query of periodic runs."""

from lectern.llm.periodic import of_rewritten
from lectern.llm.registry import query


@query("op12_periodic_runs")
def op12_periodic_runs(table):
    return of_rewritten(table("documents"))
