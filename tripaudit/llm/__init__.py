"""Training-data operators: sharding, mixing, quality, language, tokenising, near-duplicates.

Nothing outside this subpackage imports it. Each operator module has the
general operator; ``registry`` holds the thin ``opN_*`` queries and their SQL.
"""
