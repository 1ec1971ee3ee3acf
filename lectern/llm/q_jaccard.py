"""Query of the n-gram Jaccard join."""

from lectern.llm.jaccard import join
from lectern.llm.registry import query


@query("op2_ngram_jaccard")
def op2_ngram_jaccard(table):
    return join(table("documents")).select("doc_id", "n_shingles", "component_id")
