"""Data quality: constraints a database enforces row by row, as one report job.

Rules are compiled from the schemas of the nine vocabulary tables: not-null rules from
their columns, foreign keys from the columns' names, keys from ``KEYS``.  Every rule yields
(rule, table_name, bad_rows).  Not-null and check rules of a table are evaluated in a
single aggregate (``count_if`` per rule); key duplicates are counted with one grouped
aggregate per key; orphans of all foreign keys with one anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.readers import VOCABULARY_SCHEMAS

# Columns of the vocabulary tables that may be null, and the keys of all tables.
NULLABLE = {
    "concept": ["standard_concept", "invalid_reason"],
    "vocabulary": ["vocabulary_version"],
    "concept_relationship": ["invalid_reason"],
    "drug_strength": ["amount_value", "amount_unit_concept_id", "numerator_value", "numerator_unit_concept_id",
                      "denominator_value", "denominator_unit_concept_id", "box_size", "invalid_reason"],
}
KEYS = {
    "concept": ["concept_id"],
    "vocabulary": ["vocabulary_id"],
    "domain": ["domain_id"],
    "concept_class": ["concept_class_id"],
    "relationship": ["relationship_id"],
    "concept_relationship": ["concept_id_1", "concept_id_2", "relationship_id"],
    "concept_synonym": ["concept_id", "concept_synonym_name", "language_concept_id"],
    "concept_ancestor": ["ancestor_concept_id", "descendant_concept_id"],
    "drug_strength": ["drug_concept_id", "ingredient_concept_id"],
    "mapper_project": ["m_project_id"],
}
# Allowed codes of the check constraints.
STANDARD_VALUES = ["C", "S"]
INVALID_VALUES = ["D", "U"]


def _report(table: str, df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    agg = df.agg(*[F.count_if(c).alias(f"r{i}") for i, c in enumerate(rules.values())])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("bad_rows")) for i, name in enumerate(rules)]))
    return agg.select(stacked.alias("x")).select("x.rule", F.lit(table).alias("table_name"), "x.bad_rows")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def duplicates(t) -> DataFrame:
    """Rows whose key is shared with another row, per table."""
    frames = []
    for table, keys in KEYS.items():
        g = getattr(t, table).groupBy(*keys).agg(F.count(F.lit(1)).alias("ct")).filter(F.col("ct") > 1)
        frames.append(g.agg(F.coalesce(F.sum("ct"), F.lit(0)).cast("long").alias("bad_rows"))
                      .select(F.lit("duplicate_key").alias("rule"), F.lit(table).alias("table_name"), "bad_rows"))
    return _union(frames)


def columns(table: str) -> list[str]:
    return [c.split()[0] for c in VOCABULARY_SCHEMAS[table].split(", ")]


def parent(table: str, column: str) -> tuple[str, str] | None:
    """The table and key that a column of a vocabulary table points to, by its name; None
    for plain columns and for a table's own key."""
    if KEYS[table] == [column]:
        return None
    if column.endswith("concept_id") or column in ("concept_id_1", "concept_id_2"):
        return "concept", "concept_id"
    for name in ("domain", "vocabulary", "concept_class", "relationship"):
        if column in (f"{name}_id", f"reverse_{name}_id"):
            return name, f"{name}_id"
    return None


def foreign_keys() -> list[tuple[str, str, str, str, Column]]:
    """(table, column, parent table, parent key, value) of every foreign key."""
    out = [(table, c, *to, F.col(c)) for table in VOCABULARY_SCHEMAS for c in columns(table) if (to := parent(table, c))]
    kinds = F.col("m_statistic_type_id").isin("AVG", "FREQ")  # other statistics are keyed by a relationship
    out.append(("mapper_statistic", "m_concept_id", "concept", "concept_id", F.when(kinds, F.col("m_concept_id"))))
    out.append(("concept", "m_project_id", "mapper_project", "m_project_id", F.col("m_project_id")))
    return out


def orphans(t) -> DataFrame:
    """Rows by foreign key whose parent row is missing.

    One pass a table: all its foreign keys of a row come as (rule, parent, value), values
    are counted before they meet the keys of all parents in one anti join, so a value that
    a third of the rows hold is one row there."""
    rules = foreign_keys()
    tagged = []
    for table in dict.fromkeys(r[0] for r in rules):
        own = [F.struct(F.lit(f"orphan:{c}").alias("rule"), F.lit(to).alias("parent"), value.cast("string").alias("value"))
               for name, c, to, _, value in rules if name == table]
        tagged.append(getattr(t, table).select(F.lit(table).alias("table_name"), F.explode(F.array(*own)).alias("x"))
                      .select("table_name", "x.*"))
    counted = _union(tagged).filter(F.col("value").isNotNull()).groupBy("table_name", "rule", "parent", "value").agg(F.count(F.lit(1)).alias("n"))
    parents = _union([getattr(t, to).select(F.lit(to).alias("parent"), F.col(key).cast("string").alias("value"))
                      for to, key in dict.fromkeys((r[2], r[3]) for r in rules)])
    missing = counted.join(parents, ["parent", "value"], "left_anti").groupBy("table_name", "rule").agg(F.sum("n").alias("n"))
    all_rules = t.spark.createDataFrame([(r[0], f"orphan:{r[1]}") for r in rules], "table_name string, rule string")
    return all_rules.join(missing, ["table_name", "rule"], "left").select(
        "rule", "table_name", F.coalesce("n", F.lit(0)).cast("long").alias("bad_rows"))


def checks(t) -> DataFrame:
    """Check predicates and not-null columns of the nine vocabulary tables, one aggregate a table."""
    frames = []
    for table in VOCABULARY_SCHEMAS:
        rules = {f"not_null:{c}": F.col(c).isNull() for c in columns(table) if c not in NULLABLE.get(table, ())}
        if table == "concept":
            rules["check:concept_name_not_empty"] = F.trim("concept_name") == ""
            rules["check:concept_code_not_empty"] = F.trim("concept_code") == ""
            rules["check:standard_concept"] = (F.col("standard_concept").isNotNull()
                                               & ~F.col("standard_concept").isin(STANDARD_VALUES))
        if "invalid_reason" in columns(table):
            rules["check:invalid_reason"] = (F.col("invalid_reason").isNotNull()
                                             & ~F.col("invalid_reason").isin(INVALID_VALUES))
        frames.append(_report(table, getattr(t, table), rules))
    return _union(frames)


def report(t) -> DataFrame:
    return _union([duplicates(t), orphans(t), checks(t)])
