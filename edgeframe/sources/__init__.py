"""Sources and sinks: edge views over the given tables, and text formats."""

from edgeframe.sources.tables import (  # noqa: F401
    load_table, edges_ps, edges_sp, edges_co, points_chars, chain_graph,
    chain_over_keys, vertices_of,
)
from edgeframe.sources.files import (  # noqa: F401
    write_edges_csv, read_edges_csv, read_edges_csv_inferred, read_text_lines,
    write_pairs_tsv, read_pairs_tsv, write_adjacency_text, read_adjacency_text,
    write_key_value_text, read_whitespace_tokens, write_search_state, read_search_state,
)
