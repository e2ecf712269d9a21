"""Readers: keyed logs (files or Kafka), JSON document folders, text listings, registries."""

from tessera.sources.log import read_log, stream_log, decode_value, read_topics, read_or_empty  # noqa: F401
from tessera.sources.docs import read_json_docs  # noqa: F401
from tessera.sources.listing import parse_listing, parse_connectors, parse_registry  # noqa: F401
