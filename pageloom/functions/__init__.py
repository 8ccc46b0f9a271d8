"""Column functions: urls, pagination, page classes, HTML, embedded JSON, cleaning."""
