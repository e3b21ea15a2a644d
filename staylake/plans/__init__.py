"""Plans: cleaning, staging, star-schema loading and the end-to-end run."""

from .clean import CleanConfig, clean_listings, clean_report  # noqa: F401
from .etl import RunConfig, run_etl  # noqa: F401
from .star import StarOptions, build_star, load_staging, read_star  # noqa: F401
