"""chartweave: ranking tables in, clean canonical datasets out, as Spark plans."""

__version__ = "0.1.0"
