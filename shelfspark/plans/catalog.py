"""Importing this module registers every query."""

from shelfspark.plans import code_queries, eval_queries, listing_queries, misc_queries, package_queries, quote_queries, relational_queries, reply_queries, scan_queries, scoring_queries, source_queries, state_queries, store_queries, stream_queries, text_queries, tree_queries  # noqa: F401
