"""The listing in flight (11 columns) and as stored (14 columns); missing values are 0 or an empty text, never null."""

from __future__ import annotations

from pyspark.sql import types as T

TEXTS = ("id", "portal", "tipo", "barrio", "url")
MEASURES = ("precio", "area", "habitaciones", "banos", "parqueaderos", "estrato")

LISTING = T.StructType(
    [T.StructField(c, T.LongType() if c == "precio" else T.IntegerType() if c in MEASURES else T.StringType()) for c in ("id", "portal", "tipo", *MEASURES, "barrio", "url")]
)
STORED = T.StructType([*LISTING.fields, T.StructField("ciudad", T.StringType()), T.StructField("status", T.StringType()), T.StructField("scraped_at", T.TimestampType())])

GRAPHQL_DOCUMENT = T.StructType(
    [
        T.StructField("code", T.StringType()), T.StructField("property_type", T.StringType()), T.StructField("field_lease_value", T.DoubleType()), T.StructField("field_area", T.DoubleType()),
        T.StructField("field_bedrooms", T.IntegerType()), T.StructField("field_bathrooms", T.IntegerType()), T.StructField("field_garages", T.IntegerType()), T.StructField("field_stratum", T.IntegerType()),
        T.StructField("neighborhood", T.StringType()), T.StructField("url", T.StringType()),
    ]
)
GRAPHQL_ENVELOPE = T.StructType([T.StructField("data", T.StructType([T.StructField("searchAPISearch", T.StructType([T.StructField("result_count", T.IntegerType()), T.StructField("documents", T.ArrayType(GRAPHQL_DOCUMENT))]))]))])
REST_ITEM = T.StructType([T.StructField(c, T.StringType()) for c in ("codigo", "tipo", "valor", "area", "cuartos", "barrio", "link")])
