"""Training-data operators: dedup, quality, search, tokens, HTML, mixing, licences.

Nothing else in the library imports this subpackage. Every operator is a function from
DataFrame to DataFrame; `queries` holds the thin registered queries.
"""
