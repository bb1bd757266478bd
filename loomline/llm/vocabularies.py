"""Paths of the public vocabularies that the queries use; the operators take any."""

from __future__ import annotations

import public_tokenizers

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
