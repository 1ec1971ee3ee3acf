"""All registered queries of this package."""

from lectern.llm import q_jaccard, q_langid, q_lines, q_mixing, q_periodic, q_phrases, q_pii, q_repeats, q_syncmers, q_tokens, q_topk, q_urlfilter  # noqa: F401
from lectern.llm.registry import QUERIES, SQL  # noqa: F401
