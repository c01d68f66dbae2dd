"""Rules compiled from the vocabulary schemas find planted faults, and only those."""

from pyspark.sql import functions as F

from termspark.operators import quality
from termspark.sources.readers import VOCABULARY_SCHEMAS
from termspark.sources.tables import Tables


def bad(df):
    return {(r.table_name, r.rule): r.bad_rows for r in df.collect() if r.bad_rows}


def test_every_column_has_its_rules(spark):
    keys = {(t, c): to for t, c, to, *_ in quality.foreign_keys()}
    assert keys["concept", "domain_id"] == "domain" and keys["relationship", "reverse_relationship_id"] == "relationship"
    assert keys["drug_strength", "amount_unit_concept_id"] == "concept" and ("domain", "domain_id") not in keys
    assert ("concept", "concept_id") not in keys and keys["vocabulary", "vocabulary_concept_id"] == "concept"
    assert set(VOCABULARY_SCHEMAS) <= set(quality.KEYS) and all(set(k) <= set(quality.columns(t)) for t, k in quality.KEYS.items() if t in VOCABULARY_SCHEMAS)


def test_planted_faults(spark, small_dir):
    clean = Tables(spark, small_dir)
    before = bad(quality.orphans(clean)), bad(quality.checks(clean)), bad(quality.duplicates(clean))
    gone = clean.domain.agg(F.min("domain_id")).first()[0]
    rows = clean.concept.where(F.col("domain_id") == gone).count()
    t = clean.with_frames(
        domain=clean.domain.where(F.col("domain_id") != gone).unionByName(clean.domain.where(F.col("domain_id") != gone).limit(1)),
        vocabulary=clean.vocabulary.withColumn("vocabulary_reference", F.lit(None).cast("string")),
        drug_strength=clean.drug_strength.withColumn("invalid_reason", F.lit("X")).withColumn("amount_unit_concept_id", F.lit(-1).cast("long")))
    after = bad(quality.orphans(t)), bad(quality.checks(t)), bad(quality.duplicates(t))
    strengths = clean.drug_strength.count()
    assert after[0] == {**before[0], ("concept", "orphan:domain_id"): rows, ("drug_strength", "orphan:amount_unit_concept_id"): strengths}
    assert after[1] == {**before[1], ("vocabulary", "not_null:vocabulary_reference"): clean.vocabulary.count(),
                        ("drug_strength", "check:invalid_reason"): strengths}
    assert after[2] == {**before[2], ("domain", "duplicate_key"): 2}
