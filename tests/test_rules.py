"""Truth tables of the rules and of the allow-lists."""

import pytest
from pyspark.sql import functions as F

from quotegrid import reference_data as ref
from quotegrid.functions.rules import Rule, any_prefix, any_substring, classify

A_TABLE = [
    ("p4d.24xlarge", True, "Training", "A100"),
    ("p4de.24xlarge", True, "Training", "A100"),
    ("p5.48xlarge", True, "Training", "A100"),
    ("p3.2xlarge", True, "Fine-tuning", "V100"),
    ("g5.xlarge", True, "Fine-tuning", "A10G"),
    ("g4dn.xlarge", True, "Inference", "T4"),
    ("g6.xlarge", True, "Inference", "L4"),
    ("g6e.12xlarge", True, "Inference", "L4"),
    ("g6f.xlarge", True, "Inference", "L4"),
    ("inf1.xlarge", True, "Edge", "Inferentia"),
    ("inf2.xlarge", True, "Edge", "Inferentia"),
    ("g4ad.xlarge", False, "Unknown", "T4"),
    ("m5.large", False, "Unknown", "unknown"),
    ("P3.2xlarge", False, "Unknown", "unknown"),
]

B_TABLE = [
    ("ND96asr_v4", True, "Training", "A100", "on_demand"),
    ("ND96amsr_A100_v4", True, "Training", "A100", "on_demand"),
    ("ND96asrA100v4_NU", True, "Training", "A100", "on_demand"),
    ("ND40rs_v2", True, "Training", "V100", "on_demand"),
    ("NC24ads_A100_v4", True, "Fine-tuning", "unknown", "on_demand"),
    ("NC4as_T4_v3", True, "Inference", "T4", "on_demand"),
    ("NC64as_T4_v3", True, "Inference", "T4", "on_demand"),
    ("NV6ads_A10_v5", True, "Inference", "A10", "on_demand"),
    ("NV36ads_A10_v5", True, "Inference", "A10", "on_demand"),
    ("NV72ads_A10_v5", False, "Unknown", "A10", "on_demand"),
    ("NC6s_v3", True, "Edge", "P100", "on_demand"),
    ("NC12s_v3", True, "Edge", "P100", "on_demand"),
    ("NC24s_v3", True, "Edge", "P100", "on_demand"),
    ("NC24rs_v3", False, "Unknown", "P100", "on_demand"),
    ("NC4as_T4_v3 Spot", True, "Inference", "T4", "spot"),
    ("NC6s Low Priority", True, "Edge", "unknown", "spot"),
    ("NC4as_T4_v3 spot", True, "Inference", "T4", "on_demand"),
    ("Standard_NC4as_T4_v3", True, "Fine-tuning", "T4", "on_demand"),
]


def test_catalogue_a_rules(spark):
    df = spark.createDataFrame([(r[0],) for r in A_TABLE], "t string")
    t = F.col("t")
    got = df.select(
        t,
        any_prefix(t, ref.A_FAMILIES),
        classify(t, ref.A_TIERS, ref.UNKNOWN_TIER),
        classify(t, ref.A_HARDWARE, ref.UNKNOWN_HW),
    ).collect()
    assert sorted(tuple(r) for r in got) == sorted(A_TABLE)


def test_catalogue_b_rules(spark):
    df = spark.createDataFrame([(r[0],) for r in B_TABLE], "t string")
    t = F.col("t")
    got = df.select(
        t,
        any_substring(t, ref.B_KEYWORDS),
        classify(t, ref.B_TIERS, ref.UNKNOWN_TIER, ignore_case=True),
        classify(t, ref.B_HARDWARE, ref.UNKNOWN_HW, ignore_case=True),
        classify(t, ref.B_PRICE_TYPES, ref.DEFAULT_PRICE_TYPE),
    ).collect()
    assert sorted(tuple(r) for r in got) == sorted(B_TABLE)


def test_null_text_gets_the_default(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(classify(F.col("t"), ref.A_TIERS, "none")).first()[0] == "none"
    assert df.where(any_prefix(F.col("t"), ["p"])).isEmpty()


def test_no_rules_and_no_words(spark):
    df = spark.createDataFrame([("a",)], "t string")
    assert df.select(classify(F.col("t"), [], "none")).first()[0] == "none"
    assert df.where(any_substring(F.col("t"), [])).isEmpty()


@pytest.mark.parametrize("text,label", [("ab", "x"), ("ba", "y"), ("b", "none")])
def test_conditions_of_a_rule_combine(spark, text, label):
    rules = [Rule("x", prefixes=("a",), all_of=("b",)), Rule("y", all_of=("b", "a"))]
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(classify(F.col("t"), rules, "none")).first()[0] == label


def test_lookup_has_all_instances():
    units = ref.UNITS_PER_INSTANCE
    assert len(units) == 60 and sum(1 for k in units if k[0] == "N") == 17
    assert units["inf1.24xlarge"] == 16 and units["NV72ads_A10_v5"] == 2
