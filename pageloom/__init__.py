"""pageloom: Spark jobs that turn tables of fetched web pages into clean records."""

__version__ = "0.1.0"
