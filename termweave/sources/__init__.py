from termweave.sources.readers import (
    parse_documents,
    parse_edges,
    parse_token_sets,
    read_documents,
    read_edges,
    read_lines,
    read_saved,
    read_token_sets,
)
from termweave.sources.tables import scan
from termweave.sources.writers import (
    postings_lines,
    relative_frequency_lines,
    similarity_lines,
    write_postings,
    write_relative_frequencies,
    write_similarities,
)

__all__ = [
    "parse_documents",
    "parse_edges",
    "parse_token_sets",
    "postings_lines",
    "read_documents",
    "read_edges",
    "read_lines",
    "read_saved",
    "read_token_sets",
    "relative_frequency_lines",
    "scan",
    "similarity_lines",
    "write_postings",
    "write_relative_frequencies",
    "write_similarities",
]
