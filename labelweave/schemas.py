"""Schemas of requests, responses and the persisted tables."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, LongType, StringType, StructField, StructType,
                               TimestampType)

OVERRIDES = StructType([
    StructField("id", LongType()), StructField("bibcode", StringType()), StructField("scix_id", StringType()),
    StructField("override", ArrayType(StringType())), StructField("created", TimestampType())])
SCORES = StructType([
    StructField("id", LongType()), StructField("bibcode", StringType()), StructField("scix_id", StringType()),
    StructField("scores", StringType()), StructField("created", TimestampType()),
    StructField("overrides_id", LongType()), StructField("run_id", LongType())])
FINAL_COLLECTION = StructType([
    StructField("id", LongType()), StructField("bibcode", StringType()), StructField("scix_id", StringType()),
    StructField("score_id", LongType()), StructField("collection", ArrayType(StringType())),
    StructField("validated", BooleanType()), StructField("validated_at", TimestampType()),
    StructField("created", TimestampType())])
RUNS = StructType([StructField("id", LongType()), StructField("run", StringType()),
                   StructField("created", TimestampType()), StructField("model_id", LongType())])
MODELS = StructType([StructField("id", LongType()), StructField("model", StringType()),
                     StructField("postprocessing", StringType()), StructField("created", TimestampType())])
RESPONSE = StructType([StructField("bibcode", StringType()), StructField("scix_id", StringType()),
                       StructField("status", StringType()), StructField("collections", ArrayType(StringType()))])
# Pre-ingest claims: one row per replay fingerprint.
CLAIMS = "id string, stage string, lease_until double"
