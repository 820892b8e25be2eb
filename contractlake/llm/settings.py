"""Parameters that the queries and the pipeline share."""

from __future__ import annotations

import public_tokenizers

QUALITY_THRESHOLD = 0.7
SHINGLE = 3
MAX_BITS = 3
MIX_WEIGHTS = (5, 2, 1)

# The vocabulary lies outside the repository, at the same path on every machine.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
