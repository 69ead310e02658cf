"""Fixed schemas of the raw catalogues and of each layer."""

from pyspark.sql import types as T


def _nullable(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

# Catalogue A: one SKU per line, products and terms in two folders.
CATALOG_A_PRODUCTS = _nullable(("sku", _S), ("attributes", T.MapType(_S, _S)))
PRICE_DIMENSION = _nullable(("pricePerUnit", T.MapType(_S, _S)))
OFFER = _nullable(("priceDimensions", T.MapType(_S, PRICE_DIMENSION)))
CATALOG_A_TERMS = _nullable(("sku", _S), ("offers", T.MapType(_S, OFFER)))

# Catalogue B: one result page per line.
CATALOG_B_ITEM = _nullable(
    ("skuName", _S),
    ("productName", _S),
    ("unitPrice", _D),
    ("currencyCode", _S),
    ("serviceName", _S),
    ("armRegionName", _S),
    ("priceType", _S),
)
CATALOG_B_PAGE = _nullable(("Items", T.ArrayType(CATALOG_B_ITEM)), ("NextPageLink", _S))

# As landed: an item keeps its whole text, fields that the schema above lacks included.
CATALOG_B_RAW_PAGE = _nullable(("Items", T.ArrayType(_S)), ("NextPageLink", _S))

# Superset of both providers' landed rows; a column one provider lacks reads as null. A fixed
# layout; three names are the project's own: hw_type, as not all hardware is of one kind,
# unit_text, as the text is no count, and tier, as it classes more than workloads.
LANDING = _nullable(
    ("provider", _S),
    ("instance_type", _S),
    ("product_name", _S),
    ("hw_type", _S),
    ("unit_text", _S),
    ("vcpu", _S),
    ("memory_gb", _S),
    ("region", _S),
    ("price_per_hour", _D),
    ("price_type", _S),
    ("currency", _S),
    ("tier", _S),
    ("raw_payload", _S),
)

CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"
LOAD = "load"

LOAD_COLUMNS = _nullable(
    (LOAD, T.IntegerType()), ("ingested_at", T.TimestampType()), ("source_file", _S)
)

# Neither of these is carried into Silver; dropping them early keeps them out of shuffles.
RAW_ONLY = ["unit_text", "vcpu", "memory_gb", "raw_payload", CORRUPT, RESCUED]

BRONZE = T.StructType(
    [*LANDING.fields, T.StructField(CORRUPT, _S), T.StructField(RESCUED, _S), *LOAD_COLUMNS.fields]
)

SILVER = _nullable(
    ("provider", _S),
    ("instance_type", _S),
    ("hw_type", _S),
    ("unit_count", _L),
    ("unit_count_known", T.BooleanType()),
    ("region", _S),
    ("tier", _S),
    ("price_type", _S),
    ("price_per_hour", _D),
    ("unit_price", _D),
    ("currency", _S),
    ("ingested_at", T.TimestampType()),
    ("transformed_at", T.TimestampType()),
    ("source_file", _S),
)
PERF_COLUMNS = _nullable(("perf_index", _D), ("price_per_perf_unit", _D))


def gold(providers: list[str]) -> T.StructType:
    """Gold row for a provider list; two providers give one spread, more give one each."""
    from quotegrid.operators.index import median_column, spread_columns

    base, *others = providers
    return _nullable(
        ("tier", _S),
        ("index_median", _D),
        ("index_p25", _D),
        ("index_p75", _D),
        ("index_mean", _D),
        ("index_stddev", _D),
        ("price_floor", _D),
        ("price_ceiling", _D),
        ("sample_size", _L),
        *[(median_column(p), _D) for p in providers],
        *[(c, _D) for p in others for c in spread_columns(p, len(providers))],
        ("best_value_provider", _S),
        ("best_value_instance", _S),
        ("best_value_hw", _S),
        ("best_value_region", _S),
        ("best_value_price", _D),
        ("best_value_unit_price", _D),
        ("index_date", T.DateType()),
        ("index_timestamp", T.TimestampType()),
        ("run_id", _S),
    )
