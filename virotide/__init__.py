"""virotide: viral sequencing tables (variants, depths, reads, reports) as Spark jobs."""

__version__ = "0.1.0"
