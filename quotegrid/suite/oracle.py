"""SQL counterparts of the registered queries, for an independent engine.

Rounding goes through decimals, since engines disagree on rounding binary halves.
"""

from __future__ import annotations

from quotegrid.suite import bindings as b

CUTOFF = "TIMESTAMP '1998-06-30 00:00:00'"
KEYS = "provider, instance_type, region, price_type"


def dec(expr: str, scale: int = 4) -> str:
    """``expr`` rounded half up as written in decimal digits."""
    digits = f"cast(cast(cast({expr} as double) as varchar) as decimal(38,16))"
    return f"cast(round({digits}, {scale}) as double)"


def mean(col: str) -> str:
    """Average of positive values in whole 1e-8 steps, so that halves stay exact."""
    steps = f"2 * sum(cast(round({col} * 1e8) as hugeint))"
    return f"cast(({steps} + count({col}) * 10000) // (2 * count({col}) * 10000) as double) / 1e4"


def names(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"




def quotes(instance: str = "p_brand", region: str = "n_name") -> str:
    return f"""quotes AS (
  SELECT CASE l_linestatus WHEN 'F' THEN 'P1' ELSE 'P2' END AS provider,
    {instance} AS instance_type, p_name AS product_name, p_type AS hw_type, {region} AS region,
    l_extendedprice AS price_per_hour,
    CASE l_returnflag WHEN 'R' THEN 'spot' ELSE 'on_demand' END AS price_type,
    'USD' AS currency,
    CASE p_type WHEN 'PROMO' THEN 'Training' WHEN 'LARGE' THEN 'Training'
      WHEN 'MEDIUM' THEN 'Fine-tuning' WHEN 'SMALL' THEN 'Inference'
      WHEN 'ECONOMY' THEN 'Edge' ELSE 'Unknown' END AS tier,
    l_shipdate AS ingested_at, s_name AS source_file
  FROM lineitem JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""


QUOTES = quotes()
FINE_QUOTES = quotes("p_brand || '-' || p_partkey", "n_name || ':' || s_suppkey")

NEWEST = """ingested_at DESC NULLS LAST, price_per_hour NULLS LAST, product_name NULLS LAST,
  hw_type NULLS LAST, currency NULLS LAST, tier NULLS LAST, source_file NULLS LAST"""

OK = """price_per_hour IS NOT NULL AND price_per_hour > 0 AND NOT isnan(price_per_hour)
  AND price_per_hour < 1e15 AND tier IS NOT NULL AND tier <> 'Unknown' AND hw_type IS NOT NULL"""


def newest(source: str, name: str = "latest") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY {KEYS} ORDER BY {NEWEST}) AS rn FROM {source}) WHERE rn = 1)"""


BRAND = "regexp_replace(instance_type, '-[0-9]+$', '')"
UNITS = f"CASE {BRAND} WHEN 'Brand#1' THEN 8 WHEN 'Brand#2' THEN 4 WHEN 'Brand#3' THEN 2 END"


def silver(source: str = "latest", extra: str = "") -> str:
    return f"""silver AS (
  SELECT *, {dec("price_per_hour / unit_count")} AS unit_price FROM (
    SELECT {extra} provider, instance_type, hw_type,
      cast(coalesce({UNITS}, 1) AS bigint) AS unit_count,
      ({UNITS}) IS NOT NULL AS unit_count_known,
      region, tier, price_type, price_per_hour, currency, ingested_at, source_file
    FROM {source} WHERE {OK}))"""


UNIVERSE = "universe AS (SELECT * FROM silver WHERE price_type = 'on_demand' AND tier <> 'Edge')"
BASE = (FINE_QUOTES, newest("quotes"), silver(), UNIVERSE)

MOMENTS = f"""{mean("unit_price")} AS index_mean,
    {dec("stddev_samp(unit_price)")} AS index_stddev,
    {dec("min(unit_price)")} AS price_floor, {dec("max(unit_price)")} AS price_ceiling,
    count(*) AS sample_size"""


def index_cte(keys: str = "tier") -> str:
    return f"""idx AS (
  SELECT {keys}, quantile_disc(unit_price, 0.5) AS index_median,
    quantile_disc(unit_price, 0.25) AS index_p25, quantile_disc(unit_price, 0.75) AS index_p75,
    {MOMENTS} FROM universe GROUP BY {keys})"""


def summary_cte(keys: str = "tier") -> str:
    return f"""summary AS (
  SELECT {keys}, provider, quantile_disc(unit_price, 0.5) AS provider_median,
    {mean("unit_price")} AS provider_mean, count(*) AS sample_size
  FROM universe GROUP BY {keys}, provider)"""


def spread_cte(base: str = "P1", other: str = "P2", keys: str = "tier") -> str:
    b_, o = f"{base.lower()}_median", f"{other.lower()}_median"
    return f"""spread AS (
  SELECT *, {dec(f"{o} - {b_}")} AS provider_spread,
    {dec(f"({o} - {b_}) / nullif({b_}, 0) * 100", 2)} AS spread_pct
  FROM (SELECT {keys}, max(CASE WHEN provider = '{base}' THEN provider_median END) AS {b_},
      max(CASE WHEN provider = '{other}' THEN provider_median END) AS {o}
    FROM summary GROUP BY {keys}))"""


def best_cte(keys: str = "tier") -> str:
    return f"""best AS (
  SELECT {keys}, provider AS best_value_provider, instance_type AS best_value_instance,
    hw_type AS best_value_hw, region AS best_value_region,
    price_per_hour AS best_value_price, unit_price AS best_value_unit_price
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY unit_price, price_per_hour,
    provider, instance_type, region, hw_type) AS rn FROM universe) WHERE rn = 1)"""


def gold_ctes(keys: str = "tier", base: str = "P1", other: str = "P2") -> tuple[str, ...]:
    return (
        index_cte(keys),
        summary_cte(keys),
        spread_cte(base, other, keys),
        best_cte(keys),
        f"""gold AS (
  SELECT * FROM idx LEFT JOIN spread USING ({keys}) LEFT JOIN best USING ({keys}))""",
    )


STAMPS = """DATE '2002-01-01' AS index_date,
    TIMESTAMP '2002-01-01 06:00:00' AS index_timestamp, '20020101_060000' AS run_id"""
GOLD_ROWS = with_(*BASE, *gold_ctes())
GOLD = GOLD_ROWS + "SELECT * FROM gold"
STAMPED = GOLD_ROWS + f"SELECT *, {STAMPS} FROM gold"

SERIES = with_(
    QUOTES,
    f"""monthly AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, cast(date_trunc('month', ingested_at) AS date) AS m,
    row_number() OVER (PARTITION BY {KEYS}, date_trunc('month', ingested_at)
      ORDER BY {NEWEST}) AS rn FROM quotes) WHERE rn = 1)""",
    """months AS (
  SELECT cast(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS date) AS index_month
  FROM monthly)""",
    f"""standing AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY index_month, {KEYS} ORDER BY m DESC) AS rn
    FROM months JOIN monthly ON m <= index_month) WHERE rn = 1)""",
    silver("standing", "index_month,"),
    UNIVERSE,
    *gold_ctes("index_month, tier"),
    """series AS (
  SELECT * EXCLUDE (index_month), last_day(index_month) AS index_date FROM gold)""",
)
SERIES_COLUMNS = "index_date, tier, index_median, index_mean, sample_size, spread_pct"


def weighted() -> str:
    return f"""weighted AS (
  SELECT *, {dec("unit_price / perf_index")} AS price_per_perf_unit FROM (
    SELECT *, cast(CASE hw_type WHEN 'PROMO' THEN 1.0 WHEN 'LARGE' THEN 0.5
      WHEN 'MEDIUM' THEN 0.4 ELSE 0.25 END AS double) AS perf_index FROM silver))"""


def brand_name(values: list[str]) -> str:
    return f"{names(values)}[cast(replace(p_brand, 'Brand#', '') AS integer)]"


def starts(col: str, *prefixes: str) -> str:
    return "(" + " OR ".join(f"starts_with({col}, '{p}')" for p in prefixes) + ")"


def has(col: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


A_LISTED = starts("instance", "p4", "p5", "p3", "g5", "g4dn", "g6", "inf1", "inf2")
A_TIER = f"""CASE WHEN {starts("instance", "p4", "p5")} THEN 'Training'
    WHEN {starts("instance", "p3", "g5")} THEN 'Fine-tuning'
    WHEN {starts("instance", "g4dn", "g6")} THEN 'Inference'
    WHEN {starts("instance", "inf1", "inf2")} THEN 'Edge' ELSE 'Unknown' END"""
A_HW = f"""CASE WHEN {starts("instance", "p4d", "p4de", "p5")} THEN 'A100'
    WHEN {starts("instance", "p3")} THEN 'V100' WHEN {starts("instance", "g5")} THEN 'A10G'
    WHEN {starts("instance", "g4dn", "g4ad")} THEN 'T4'
    WHEN {starts("instance", "g6")} THEN 'L4'
    WHEN {starts("instance", "inf1", "inf2")} THEN 'Inferentia' ELSE 'unknown' END"""

CATALOG_A = (
    """terms AS (
  SELECT l_partkey, CASE WHEN l_partkey % 3 <> 2 THEN low
      WHEN high > 104000 OR low < 1500 THEN NULL ELSE high END AS price
  FROM (SELECT l_partkey, min(l_extendedprice) AS low, max(l_extendedprice) AS high
    FROM lineitem GROUP BY l_partkey))""",
    f"""rows_a AS (
  SELECT 'AWS' AS provider, instance AS instance_type, {A_HW} AS hw_type,
    'us-east-1' AS region, price AS price_per_hour, 'on_demand' AS price_type, {A_TIER} AS tier,
    CASE WHEN p_type <> 'PROMO' THEN p_size || ' GB' ELSE 'unknown' END AS unit_text,
    cast(p_size AS varchar) AS vcpu, p_name AS memory_gb, p_type, p_size
  FROM (SELECT *, {brand_name(b.INSTANCES)} AS instance FROM part)
    JOIN terms ON l_partkey = p_partkey
  WHERE {A_LISTED} AND p_size <= 40 AND p_type <> 'ECONOMY' AND p_size <> 7
    AND price IS NOT NULL AND price <> 0)""",
)

B_LISTED = has("lower(sku)", "nd96asr", "nd96amsr", "nd40rs", "nc24ads", "nc4as", "nc8as",
               "nc16as", "nc64as", "nv6ads", "nv18ads", "nv36ads",
               "nc6s", "nc12s", "nc24s")
B_TIER = f"""CASE WHEN {has("txt", "nd96asr", "nd96amsr", "nd40rs")} THEN 'Training'
    WHEN {has("txt", "nc24ads", "nd")} THEN 'Fine-tuning'
    WHEN {has("txt", "nc4as", "nc8as", "nc16as", "nc64as", "nv6ads", "nv18ads", "nv36ads")}
      THEN 'Inference'
    WHEN {has("txt", "nc6s", "nc12s", "nc24s")} THEN 'Edge' ELSE 'Unknown' END"""
B_HW = """CASE WHEN contains(txt, 'nd96') THEN 'A100'
    WHEN contains(txt, 'nv') AND contains(txt, 'ads') THEN 'A10'
    WHEN contains(txt, 'nc') AND contains(txt, 'as') THEN 'T4'
    WHEN contains(txt, 'nd40rs') THEN 'V100'
    WHEN contains(txt, 'nc') AND contains(txt, 's_v') THEN 'P100' ELSE 'unknown' END"""

CATALOG_B = (
    f"""items AS (
  SELECT *, CASE p_type WHEN 'PROMO' THEN 'eastus' WHEN 'LARGE' THEN 'westus2'
      WHEN 'MEDIUM' THEN 'eastus2' WHEN 'SMALL' THEN 'eastus' ELSE 'northeurope' END AS region
  FROM (SELECT *, base AS sku, p_retailprice AS price,
      CASE WHEN p_size <> 3 THEN p_name END AS product FROM named
    UNION ALL SELECT *, base || ' Spot', p_retailprice / 4, p_name FROM named
    UNION ALL SELECT *, base, p_retailprice * 2, p_name || ' Windows' FROM named))""",
    f"""rows_b AS (
  SELECT 'Azure' AS provider, sku AS instance_type, {B_HW} AS hw_type, region,
    price AS price_per_hour,
    CASE WHEN contains(sku, 'Spot') OR contains(sku, 'Low Priority') THEN 'spot'
      ELSE 'on_demand' END AS price_type,
    {B_TIER} AS tier, product AS product_name, 'USD' AS currency, p_partkey, p_size
  FROM (SELECT *, lower(regexp_replace(sku, '^Standard_', '')) AS txt FROM items)
  WHERE p_size <> 50 AND p_size <> 49 AND region <> 'northeurope'
    AND NOT coalesce(contains(product, 'Windows'), false) AND {B_LISTED})""",
)
NAMED = f"named AS (SELECT *, {brand_name(b.SKUS)} AS base FROM part)"

RUN_UNITS = """run_units AS (SELECT * FROM (VALUES
  ('p4d.24xlarge', 8), ('p4de.24xlarge', 8), ('p5.48xlarge', 8), ('p3.8xlarge', 4),
  ('p3.16xlarge', 8), ('p3dn.24xlarge', 8), ('g5.12xlarge', 4), ('g5.48xlarge', 8),
  ('g4dn.12xlarge', 4), ('g6.12xlarge', 4), ('g6f.48xlarge', 8), ('inf1.24xlarge', 16),
  ('inf2.48xlarge', 12), ('ND96asr_v4', 8), ('ND96amsr_A100_v4', 8),
  ('ND96asrA100v4_NU', 8), ('ND40rs_v2', 8), ('NC64as_T4_v3', 4), ('NC12s_v3', 2),
  ('NC24s_v3', 4)
  ) AS u(name, n))"""

DAILY_RUN = with_(
    *CATALOG_A,
    NAMED,
    *CATALOG_B,
    RUN_UNITS,
    "bronze AS (SELECT * FROM rows_a UNION ALL BY NAME SELECT * FROM rows_b)",
    f"""latest AS (
  SELECT provider, instance_type, region, price_type, min(price_per_hour) AS price_per_hour,
    min(hw_type) AS hw_type, min(tier) AS tier FROM bronze GROUP BY {KEYS})""",
    f"""universe AS (
  SELECT *, {dec("price_per_hour / units")} AS unit_price FROM (
    SELECT latest.*, coalesce(n, 1) AS units FROM latest
      LEFT JOIN run_units ON name = regexp_replace(instance_type, '^Standard_', ''))
  WHERE tier NOT IN ('Unknown', 'Edge') AND price_type = 'on_demand' AND price_per_hour > 0)""",
    *gold_ctes("tier", "AWS", "Azure"),
)

ORACLE_SQL = {
    "q01_tier_index": with_(*BASE, index_cte()) + "SELECT * FROM idx",
    "q02_provider_summary": with_(*BASE, summary_cte()) + "SELECT * FROM summary",
    "q03_provider_spread": with_(*BASE, summary_cte(), spread_cte()) + "SELECT * FROM spread",
    "q04_best_value": with_(*BASE, best_cte()) + "SELECT * FROM best",
    "q05_gold_assembled": GOLD,
    "q06_gold_single_pass": STAMPED,
    "q07_latest_per_key": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts DESC, event_id, value, props) AS rn
      FROM events) WHERE rn = 1""",
    "q08_quality_gate_rejects": with_(QUOTES)
    + """SELECT CASE WHEN price IS NULL THEN 'price missing' WHEN price <= 0
        THEN 'price not positive' ELSE 'tier unknown' END AS reject_reason,
      tier, count(*) AS n
    FROM (SELECT *, price_per_hour - 5000 AS price FROM quotes)
    WHERE price IS NULL OR price <= 0 OR tier = 'Unknown' GROUP BY ALL""",
    "q09_unit_normalise": with_(QUOTES)
    + f"""SELECT instance_type, price_per_hour, unit_count, unit_count_known,
      {dec("price_per_hour / unit_count")} AS unit_price
    FROM (SELECT instance_type, price_per_hour,
      cast(coalesce({UNITS}, 1) AS bigint) AS unit_count,
      ({UNITS}) IS NOT NULL AS unit_count_known FROM quotes)""",
    "q10_prefix_rules": f"""SELECT p_partkey, instance, {A_LISTED} AS listed, {A_TIER} AS tier,
      {A_HW} AS hw_type
    FROM (SELECT p_partkey, {brand_name(b.INSTANCES)} AS instance FROM part)""",
    "q11_substring_rules": """SELECT page_id,
      contains(lower(url), 'example.org') OR contains(lower(url), 'spam-farm') AS listed,
      CASE WHEN contains(lower(url), '://blog.') THEN 'blog'
        WHEN contains(lower(url), 'utm_source=') OR contains(lower(url), 'ref=') THEN 'campaign'
        WHEN contains(lower(url), 'https:') AND contains(lower(url), '//m.')
          THEN 'secure mobile' ELSE 'other' END AS label
    FROM pages""",
    "q12_prefix_strip": "SELECT p_partkey, replace(p_brand, 'Brand#', '') AS brand FROM part",
    "q13_predicate_conjunction": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      l_extendedprice, l_discount FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount <> 0
      AND o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'""",
    "q14_json_parse_defaults": """SELECT event_id,
      cast(json_extract_string(props, '$.k') AS double) AS k,
      coalesce(json_extract_string(props, '$.currency'), 'USD') AS currency FROM events""",
    "q15_explode_nested": with_(*CATALOG_A) + "SELECT * EXCLUDE (p_type, p_size) FROM rows_a",
    "q16_union_missing_columns": """SELECT 'customer' AS party, c_name AS name,
      c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL BY NAME SELECT 'supplier' AS party, s_name AS name, s_acctbal AS balance,
      cast(s_nationkey AS bigint) AS nation FROM supplier""",
    "q17_group_counts": "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL",
    "q18_layer_counts": with_(QUOTES, newest("quotes"))
    + f"""SELECT (SELECT count(*) FROM quotes) AS bronze_rows,
      (SELECT count(*) FROM latest) AS deduped_rows,
      (SELECT count(*) FROM latest WHERE {OK}) AS clean_rows""",
    "q19_tier_summary": with_(*BASE, weighted())
    + f"""SELECT tier, {mean("price_per_hour")} AS avg_price_per_hour,
      {mean("unit_price")} AS avg_unit_price,
      {mean("price_per_perf_unit")} AS avg_perf_price, count(*) AS n
    FROM weighted WHERE price_type = 'on_demand' GROUP BY tier""",
    "q20_perf_adjusted": with_(*BASE, weighted())
    + "SELECT *, TIMESTAMP '2002-01-01 06:00:00' AS transformed_at FROM weighted",
    "q21_dispersion_iqr": with_(*BASE, index_cte())
    + f"""SELECT tier, index_median, index_stddev,
      {dec("index_stddev / index_median * 100", 0)} AS stddev_pct,
      {dec("index_p75 - index_p25")} AS iqr FROM idx""",
    "q22_tier_premium": with_(*BASE, index_cte())
    + f"""SELECT tier, index_median, {dec('''index_median
      / (SELECT index_median FROM idx WHERE tier = 'Inference')''', 2)} AS premium FROM idx""",
    "q23_excluded_tier_index": with_(
        FINE_QUOTES,
        newest("quotes"),
        silver(),
        "universe AS (SELECT * FROM silver WHERE price_type = 'on_demand' AND tier = 'Edge')",
        *gold_ctes(),
    )
    + "SELECT * FROM gold",
    "q24_snapshot_series": SERIES
    + "SELECT *, cast(index_date AS timestamp) AS index_timestamp FROM series",
    "q25_as_of": SERIES + f"SELECT {SERIES_COLUMNS} FROM series WHERE index_date <= {CUTOFF}",
    "q26_latest_snapshot": SERIES
    + f"""SELECT {SERIES_COLUMNS} FROM (SELECT *, row_number() OVER (
      PARTITION BY tier ORDER BY index_date DESC) AS rn FROM series) WHERE rn = 1""",
    "q27_version_as_of": SERIES
    + f"""SELECT {SERIES_COLUMNS} FROM (SELECT *, dense_rank() OVER (ORDER BY index_date) AS v
      FROM series) WHERE v <= 6""",
    "q28_stream_bronze": """SELECT event_id, ts, user_id, event_type, value, props,
      cast(CASE event_type WHEN 'purchase' THEN 1 ELSE 2 END AS integer) AS load,
      cast(NULL AS varchar) AS _rescued_data, true AS stamped FROM events""",
    "q29_snapshot_rewrite": SERIES
    + """SELECT index_date, mode, count(*) * max(times) AS n FROM series,
      (VALUES ('append', 2), ('replace_date', 1)) AS modes(mode, times) GROUP BY ALL""",
    "q30_stream_quarantine": """SELECT CASE WHEN event_type IN ('error', 'signup')
        THEN 'quarantined' ELSE 'good' END AS state,
      CASE WHEN event_type NOT IN ('error', 'signup') THEN event_id END AS event_id,
      CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS event_type,
      CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS value,
      CASE event_type WHEN 'error' THEN '{"event_id": ' || event_id
        WHEN 'signup' THEN '{"event_id":' || event_id
          || ',"event_type":"signup","value":"high"}' END AS line
    FROM events""",
    "q31_approx_index": with_(*BASE)
    + """SELECT tier, count(*) AS sample_size, true AS index_p25_within,
      true AS index_median_within, true AS index_p75_within FROM universe GROUP BY tier""",
    "q32_reports": with_(*BASE, *gold_ctes())
    + """SELECT tier, index_median, index_p25, index_p75, index_stddev, p1_median, p2_median,
      provider_spread, spread_pct, best_value_provider, best_value_instance, sample_size
    FROM gold""",
    "q33_best_value_report": with_(*BASE, *gold_ctes())
    + """SELECT tier, best_value_provider, best_value_instance, best_value_hw,
      best_value_price, best_value_unit_price FROM gold""",
    "q34_paged_catalog": with_(NAMED, *CATALOG_B)
    + "SELECT * EXCLUDE (p_partkey, p_size) FROM rows_b",
    "q35_group_quantiles": """SELECT l_returnflag, l_linestatus,
      quantile_disc(l_extendedprice, 0.01) AS p01, quantile_disc(l_extendedprice, 0.25) AS p25,
      quantile_disc(l_extendedprice, 0.5) AS p50, quantile_disc(l_extendedprice, 0.75) AS p75,
      quantile_disc(l_extendedprice, 0.99) AS p99 FROM lineitem GROUP BY ALL""",
    "q36_source_inventory": with_(QUOTES)
    + """SELECT provider, source_file, count(*) AS n, min(ingested_at) AS first_ingested_at,
      max(ingested_at) AS last_ingested_at FROM quotes GROUP BY ALL""",
    "q37_region_pages": with_(QUOTES)
    + """SELECT region, count(*) AS n, count(DISTINCT source_file) AS files
    FROM quotes GROUP BY region""",
    "q38_refresh_latest": with_(QUOTES, newest("quotes")) + "SELECT * FROM latest",
    "q39_filter_first": with_(
        QUOTES, f"good AS (SELECT * FROM quotes WHERE {OK})", newest("good")
    )
    + "SELECT * FROM latest",
    "q40_raw_payload": with_(*CATALOG_A, NAMED, *CATALOG_B)
    + """SELECT instance_type, instance_type AS raw_instance,
      CASE WHEN p_type <> 'PROMO' THEN p_size || ' GB' END AS raw_memory,
      cast(NULL AS varchar) AS raw_meter,
      cast(CASE WHEN p_type <> 'PROMO' THEN 7 ELSE 6 END AS integer) AS entries FROM rows_a
    UNION ALL SELECT instance_type, instance_type, NULL, 'm' || p_partkey,
      cast(8 - CASE WHEN product_name IS NULL THEN 1 ELSE 0 END
        - CASE WHEN p_size > 25 THEN 0 ELSE 1 END AS integer) FROM rows_b""",
    "q41_ambiguous_terms": """SELECT cast(l_partkey AS varchar) AS sku,
      cast(CASE l_partkey % 3 WHEN 0 THEN 2 ELSE 3 END AS integer) AS rates FROM lineitem
    WHERE l_partkey % 3 <> 1 GROUP BY l_partkey""",
    "q43_bronze_breakdown": with_(QUOTES)
    + "SELECT provider, tier, count(*) AS n FROM quotes GROUP BY ALL",
    "q44_sub_index_spread": with_(
        FINE_QUOTES,
        newest("quotes"),
        silver(),
        "universe AS (SELECT * FROM silver WHERE price_type = 'spot')",
        summary_cte(),
        spread_cte("P2", "P1"),
    )
    + "SELECT * FROM spread",
    "q42_daily_run": DAILY_RUN + f"SELECT *, {STAMPS} FROM gold",
    "q45_units_table": with_(QUOTES)
    + f"""SELECT instance_type, price_per_hour, unit_count, true AS unit_count_known,
      {dec("price_per_hour / unit_count")} AS unit_price
    FROM quotes JOIN (SELECT p_brand, cast(max(p_size) AS bigint) AS unit_count FROM part
      GROUP BY p_brand) ON instance_type = p_brand""",
    "q46_price_range": with_(QUOTES)
    + f"""SELECT reject_reason, count(*) AS n,
      CASE WHEN reject_reason = 'none' THEN {mean("price_per_hour")} END AS mean_price
    FROM (SELECT price_per_hour, CASE WHEN price_per_hour > 100000 OR price_per_hour < 2000
        THEN 'price out of range' WHEN tier = 'Unknown' THEN 'tier unknown' ELSE 'none'
        END AS reject_reason FROM quotes) GROUP BY reject_reason""",
    "q47_exact_ranks": """SELECT l_returnflag,
      max(big) FILTER (r = (n * 7 + 99) // 100) AS p07,
      max(big) FILTER (r = (n * 14 + 99) // 100) AS p14,
      max(big) FILTER (r = (n * 28 + 99) // 100) AS p28,
      max(big) FILTER (r = (n * 55 + 99) // 100) AS p55
    FROM (SELECT l_returnflag, cast(l_orderkey AS bigint) * 100000000000 AS big,
        row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey) AS r,
        count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) GROUP BY l_returnflag""",
    "q48_rescued_fields": """SELECT event_id, event_type,
      cast(user_id AS varchar) AS rescued_user FROM events""",
    "q49_first_row": "SELECT * FROM events ORDER BY ts DESC, event_id LIMIT 1",
    "q50_run_checks": DAILY_RUN
    + """SELECT (SELECT count(*) FROM bronze) AS bronze_rows,
      (SELECT count(*) FROM latest) AS deduped_rows,
      (SELECT count(*) FROM latest WHERE tier <> 'Unknown' AND price_per_hour > 0) AS clean_rows""",
    "q51_schema_growth": """SELECT event_id, event_type, cast(event_id % 3 + 1 AS integer) AS load,
      CASE WHEN event_id % 3 = 2 AND user_id % 50 <> 0 THEN cast(user_id AS bigint) END AS user_id,
      CASE WHEN event_id % 3 = 2 THEN value END AS value,
      CASE WHEN event_id % 3 = 1 THEN cast(user_id AS varchar)
        WHEN event_id % 3 = 2 AND user_id % 50 = 0 THEN 'u' || user_id END AS rescued_user
    FROM events""",
    "q52_load_counts": """SELECT cast(event_id % 3 + 1 AS integer) AS load, count(*) AS loaded,
      count(*) FILTER (event_id % 30 = event_id % 3) AS quarantined,
      count(*) FILTER (event_id % 3 = 1 AND (user_id IS NOT NULL OR value IS NOT NULL)
        OR event_id % 3 = 2 AND user_id % 50 = 0) AS rescued
    FROM events GROUP BY event_id % 3""",
    "q53_merged_loads": with_(FINE_QUOTES, silver("quotes"), UNIVERSE, best_cte())
    + f"""SELECT *, true AS index_p25_within, true AS index_median_within,
      true AS index_p75_within FROM (SELECT tier, {MOMENTS} FROM universe GROUP BY tier)
      JOIN best USING (tier)""",
    "q54_exact_deviation": f"""SELECT l_returnflag, l_linestatus,
      round(sqrt(cast(n * squares - total * total AS double) / (n * (n - 1))) / 100, 6) AS deviation,
      true AS same
    FROM (SELECT l_returnflag, l_linestatus, cast(count(*) AS hugeint) AS n, sum(cents) AS total,
        sum(cents * cents) AS squares
      FROM (SELECT l_returnflag, l_linestatus, cast(round(l_extendedprice * 100) AS hugeint) AS cents
        FROM lineitem) GROUP BY ALL)""",
    "q55_partwise_latest": with_(
        "quotes AS (SELECT *, cast(quarter(ingested_at) AS integer) AS load FROM ("
        + QUOTES.removeprefix("quotes AS ")
        + "))",
        newest("quotes"),
    )
    + "SELECT * FROM latest",
    "q56_payload_variant": with_(*CATALOG_A, NAMED, *CATALOG_B)
    + """SELECT provider, instance_type AS instanceType, 'Linux' AS operatingSystem,
      'Shared' AS tenancy, 'Used' AS capacitystatus,
      CASE WHEN p_type <> 'PROMO' THEN p_size || ' GB' END AS gpuMemory,
      cast(p_size AS bigint) AS vcpu, memory_gb AS memory, cast(NULL AS varchar) AS skuName,
      cast(NULL AS varchar) AS productName, cast(NULL AS double) AS unitPrice,
      cast(NULL AS varchar) AS currencyCode, cast(NULL AS varchar) AS serviceName,
      cast(NULL AS varchar) AS armRegionName, cast(NULL AS varchar) AS priceType,
      cast(NULL AS varchar) AS meterId FROM rows_a
    UNION ALL SELECT provider, NULL, NULL, NULL, NULL, NULL, NULL, NULL, instance_type,
      product_name, price_per_hour, CASE WHEN p_size > 25 THEN 'USD' END, 'Virtual Machines',
      region, 'Consumption', 'm' || p_partkey FROM rows_b""",
    "q57_kept_inventory": with_(QUOTES)
    + """SELECT provider, source_file, count(*) AS n, min(ingested_at) AS first_ingested_at,
      max(ingested_at) AS last_ingested_at FROM quotes GROUP BY ALL""",
    "q58_kept_regions": with_(QUOTES)
    + """SELECT region, count(*) AS n, count(DISTINCT source_file) AS counted, true AS within
    FROM quotes GROUP BY region""",
    "q59_bucketed_terms": with_(*CATALOG_A) + "SELECT * EXCLUDE (p_type, p_size) FROM rows_a",
    "q60_namespace": "SELECT event_id, event_type FROM events WHERE event_type = 'purchase'",
    "q61_empty_batches": """SELECT kind, count(event_id) > 0 AS landed, count(event_id) AS lines
    FROM (VALUES ('purchase'), ('error'), ('none such')) AS kinds(kind)
      LEFT JOIN events ON event_type = kind GROUP BY kind""",
}
