"""Query of language identification."""

from lectern.llm.langid import fit, identify
from lectern.llm.registry import query


@query("op7_byte_cnn_langid")
def op7_byte_cnn_langid(table):
    docs = table("documents")
    return identify(docs, fit(docs))
