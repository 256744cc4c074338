"""Whole jobs built from the operators: city enrichment and preview
(``enrich``), search documents, word corpus and searches (``search``), the
file-based jobs (``files``) and the driver's tables in the source
application's shapes (``shapes``)."""
