"""Query of byte-level BPE."""

import public_tokenizers

from lectern.llm.bpe import token_digests
from lectern.llm.registry import query

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query("op1_byte_bpe")
def op1_byte_bpe(table):
    return token_digests(table("documents"), RANKS)
