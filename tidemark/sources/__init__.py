"""Source adapters: JSON topics, keyed-table snapshots, JDBC dimensions, config."""

from tidemark.sources.topic import json_topic, kafka_topic, parse_json
from tidemark.sources.tables import CachedTable, jdbc_table, keyed_table

__all__ = ["CachedTable", "jdbc_table", "json_topic", "kafka_topic", "keyed_table", "parse_json"]
