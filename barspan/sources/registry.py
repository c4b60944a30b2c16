"""Named sources from a configuration."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession


def load_config(path: str) -> dict[str, Any]:
    """A configuration file: JSON, or YAML where a YAML parser is installed."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith((".yml", ".yaml")):
        import yaml

        return yaml.safe_load(text)
    return json.loads(text)


def register_sources(spark: SparkSession, config: Mapping[str, Any], service: str | None = None) -> list[str]:
    """Create a temporary view per configured file and return the view names.

    ``config`` maps a source name to ``{"uris": [...], "format": "parquet", "schema": ddl, "options": {...}}``
    (``uri`` works too). ``config["services"][service]`` maps roles to source names and picks a subset.
    A view is named after its file, without the ending.
    """
    if service is not None:
        names = list(config["services"][service].values())
    else:
        names = [n for n in config if n != "services"]
    views = []
    for name in names:
        source = config[name]
        uris = source.get("uris", source.get("uri", []))
        for uri in [uris] if isinstance(uris, str) else uris:
            reader = spark.read.format(source.get("format", "parquet")).options(**source.get("options", {}))
            if "schema" in source:
                reader = reader.schema(source["schema"])
            view = uri.rstrip("/").rsplit("/", 1)[-1].split(".", 1)[0].replace("-", "_")
            if view in views:
                raise ValueError(f"two sources would be the view {view}")
            reader.load(uri).createOrReplaceTempView(view)
            views.append(view)
    return views
