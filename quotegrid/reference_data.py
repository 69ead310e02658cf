"""Fixed values of the two published price catalogues: allow-lists, rules and lookups."""

from quotegrid.functions.rules import Rule

PROVIDER_A = "AWS"
PROVIDER_B = "Azure"
PROVIDERS = [PROVIDER_A, PROVIDER_B]

UNKNOWN_TIER = "Unknown"
UNKNOWN_HW = "unknown"
EDGE_TIER = "Edge"

# --- fixed values: catalogue A ------------------------------------------------------
A_FAMILIES = ["p4", "p5", "p3", "g5", "g4dn", "g6", "inf1", "inf2"]
A_ATTRIBUTES = {"operatingSystem": "Linux", "tenancy": "Shared", "capacitystatus": "Used"}
A_TIERS = [
    Rule("Training", prefixes=("p4", "p5")),
    Rule("Fine-tuning", prefixes=("p3", "g5")),
    Rule("Inference", prefixes=("g4dn", "g6")),
    Rule("Edge", prefixes=("inf1", "inf2")),
]
A_HARDWARE = [
    Rule("A100", prefixes=("p4d", "p4de", "p5")),
    Rule("V100", prefixes=("p3",)),
    Rule("A10G", prefixes=("g5",)),
    Rule("T4", prefixes=("g4dn", "g4ad")),
    Rule("L4", prefixes=("g6", "g6e", "g6f")),
    Rule("Inferentia", prefixes=("inf1", "inf2")),
]

# --- fixed values: catalogue B ------------------------------------------------------
B_KEYWORDS = [
    "ND96asr", "ND96amsr", "ND40rs", "NC24ads", "NC4as", "NC8as", "NC16as", "NC64as",
    "NV6ads", "NV18ads", "NV36ads", "NC6s", "NC12s", "NC24s",
]
B_REGIONS = ["eastus", "westus2", "eastus2"]
B_SERVICE = "Virtual Machines"
B_PRICE_TYPE = "Consumption"
B_EXCLUDED_PRODUCT = "Windows"
B_TIERS = [
    Rule("Training", any_of=("nd96asr", "nd96amsr", "nd40rs")),
    Rule("Fine-tuning", any_of=("nc24ads", "nd")),
    Rule(
        "Inference",
        any_of=("nc4as", "nc8as", "nc16as", "nc64as", "nv6ads", "nv18ads", "nv36ads"),
    ),
    Rule("Edge", any_of=("nc6s", "nc12s", "nc24s")),
]
B_HARDWARE = [
    Rule("A100", all_of=("nd96",)),
    Rule("A10", all_of=("nv", "ads")),
    Rule("T4", all_of=("nc", "as")),
    Rule("V100", all_of=("nd40rs",)),
    Rule("P100", all_of=("nc", "s_v")),
]
B_PRICE_TYPES = [Rule("spot", any_of=("Spot", "Low Priority"))]
DEFAULT_PRICE_TYPE = "on_demand"
DEFAULT_CURRENCY = "USD"

# --- fixed values: both catalogues --------------------------------------------------
SKU_PREFIX = "^Standard_"

UNITS_PER_INSTANCE = {
    "p4d.24xlarge": 8, "p4de.24xlarge": 8, "p5.48xlarge": 8,
    "p3.2xlarge": 1, "p3.8xlarge": 4, "p3.16xlarge": 8, "p3dn.24xlarge": 8,
    "g5.xlarge": 1, "g5.2xlarge": 1, "g5.4xlarge": 1, "g5.8xlarge": 1,
    "g5.12xlarge": 4, "g5.16xlarge": 1, "g5.24xlarge": 4, "g5.48xlarge": 8,
    "g4dn.xlarge": 1, "g4dn.2xlarge": 1, "g4dn.4xlarge": 1, "g4dn.8xlarge": 1,
    "g4dn.12xlarge": 4, "g4dn.16xlarge": 1,
    "g6.xlarge": 1, "g6.2xlarge": 1, "g6.4xlarge": 1, "g6.8xlarge": 1,
    "g6.12xlarge": 4, "g6.16xlarge": 1, "g6.24xlarge": 4, "g6.48xlarge": 8,
    "g6f.xlarge": 1, "g6f.2xlarge": 1, "g6f.4xlarge": 1, "g6f.8xlarge": 1,
    "g6f.12xlarge": 4, "g6f.48xlarge": 8,
    "inf1.xlarge": 1, "inf1.2xlarge": 1, "inf1.6xlarge": 4, "inf1.24xlarge": 16,
    "inf2.xlarge": 1, "inf2.8xlarge": 1, "inf2.24xlarge": 6, "inf2.48xlarge": 12,
    "ND96asr_v4": 8, "ND96amsr_A100_v4": 8, "ND96asrA100v4_NU": 8, "ND40rs_v2": 8,
    "NC24ads_A100_v4": 1, "NC4as_T4_v3": 1, "NC8as_T4_v3": 1, "NC16as_T4_v3": 1,
    "NC64as_T4_v3": 4, "NV6ads_A10_v5": 1, "NV18ads_A10_v5": 1, "NV36ads_A10_v5": 1,
    "NV72ads_A10_v5": 2, "NC6s_v3": 1, "NC12s_v3": 2, "NC24s_v3": 4, "NC24rs_v3": 4,
}

PERF_WEIGHTS = {
    "A100": 1.00, "V100": 0.45, "A10": 0.35, "A10G": 0.35, "L4": 0.40, "T4": 0.20,
    "P100": 0.30, "Inferentia": 0.30, "unknown": 0.25,
}
