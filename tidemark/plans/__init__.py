"""Table recipes and the registered proof queries.

catalog       the query registry: each Spark query beside its SQL oracle
q_*           proof queries over the driver tables (one module per family)
enrollment    enrollment, contract, directory, crosswalk, special-needs tables
star_ratings  measure values and stars, display measures, cut points, summary
reports       landscape, payments, reconciliation, HEDIS, LIS, benefit summary
benefits      benefit dictionary, dictionary-typed files, Section A, documents
"""
