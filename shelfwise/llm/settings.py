"""What the registered queries and the pipeline share; every operator takes these as parameters."""

import public_tokenizers

#: A deployment passes its own secret; the queries use this one, so that their results repeat.
SURROGATE_KEY = "surrogates of the registered queries"


def bpe_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")
