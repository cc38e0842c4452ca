"""Ratings sources: CSV/TSV readers and adapters over the warehouse tables."""

from kinrank.sources.ratings import (  # noqa: F401
    canonical,
    purchase_events,
    ratings_from_events,
    ratings_from_orders,
    ratings_profile,
    read_ratings_csv,
    read_ratings_tsv,
    utility_matrix,
    write_ratings_csv,
    write_ratings_tsv,
)
