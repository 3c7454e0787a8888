"""Mask configuration documents (small JSON / YAML files)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def read_document(spark: SparkSession, path: str) -> str:
    """Whole text of one small file through Spark's file systems (any scheme)."""
    documents = spark.read.text(path, wholetext=True)
    files = documents.inputFiles()
    if not files:
        raise FileNotFoundError(path)
    if len(files) > 1:
        raise ValueError(f"{path} holds {len(files)} files; a configuration is one file")
    return documents.first().value


def load_mask_config(spark: SparkSession, path: str) -> dict:
    """JSON object ``column -> {type, meta}``."""
    return json.loads(read_document(spark, path))


def load_mask_spec(spark: SparkSession, path: str) -> dict:
    """``MockColumns`` spec, YAML (or JSON, which YAML also reads)."""
    text = read_document(spark, path)
    try:
        import yaml
    except ImportError:  # pragma: no cover - yaml is optional
        return json.loads(text)
    return yaml.safe_load(text)
