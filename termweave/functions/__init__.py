from termweave.functions.bags import bag
from termweave.functions.tokens import (
    document_tokens,
    letter_runs,
    line_tokens,
    space_tokens,
)

__all__ = ["bag", "document_tokens", "letter_runs", "line_tokens", "space_tokens"]
