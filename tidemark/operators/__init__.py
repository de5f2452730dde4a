"""DataFrame -> DataFrame operators.

projections  header renames, casts, conformance, swap check, lineage
filters      sentinels, totals, blank rows, routing, year ranges
joins        deduplicated enrichment, dictionaries, labels, remaps
aggregates   skew-safe one-row-per-key, medians, most common, concat, sets
reshape      report matrices to long facts (per-file descriptors, broadcast)
nested       deep rewrites of nested documents from the schema
entities     organisation names: standardise, pair-free typo map, canonical
dictionary   dictionary-driven typing of text tables
links        links, table rows and periods from crawled pages
incremental  new-file selection over file listings
"""
