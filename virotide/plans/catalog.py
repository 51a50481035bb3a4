"""All queries: importing the modules registers them."""

from virotide.plans import coding_queries, genome_queries, primer_queries, read_queries, report_queries, variant_queries  # noqa: F401
from virotide.plans.registry import ORACLES, QUERIES  # noqa: F401
