"""DataFrame operators: HTML selection, curation, joins, row generation, quality."""
