"""Query of exact substring dedup."""

from lectern.llm.registry import query
from lectern.llm.repeats import dedup


@query("op4_suffix_repeats")
def op4_suffix_repeats(table):
    return dedup(table("documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
