"""Dataset operators: joins, text analysis, retrieval, document building."""
