"""Table catalog.

``Tables`` gives named DataFrames: the raw driver tables (Parquet) and the
terminology views of FIXTURES.md part B derived from them (concept,
concept_relationship, concept_synonym, mapper_project, mapper_statistic, the
eight clinical event tables and the project term list).  Every view is a lazy
plan over the Parquet scans, so Catalyst prunes columns and pushes filters down
to the files; nothing is materialised here.

A caller with real OMOP tables builds ``Tables.from_frames(...)`` instead and
every operator works the same.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.stats_expr import frequency_class_expr

RAW_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()

# Fixed values of the OMOP vocabulary (language concepts) and of local ids.
LANG_EN = 4180186
LANG_FR = 4180190
LOCAL_ID_BASE = 2000000000

# Fixed values of the fixture views (FIXTURES.md part B).
FIXTURE_START = _dt.date(1970, 1, 1)
FIXTURE_END = _dt.date(2099, 12, 31)
FIXTURE_ENDED_AT = "2024-06-01 00:00:00"
FIXTURE_STAT_AT = "2024-01-01 00:00:00"
UP_EVENTS = ("purchase", "signup", "click")

# Clinical event tables: (table, concept column) - the eight sources of the statistics job.
EVENT_SOURCES = (
    ("person", "gender_concept_id"),
    ("visit_occurrence", "visit_concept_id"),
    ("visit_detail", "visit_detail_concept_id"),
    ("observation", "observation_concept_id"),
    ("measurement", "measurement_concept_id"),
    ("condition_occurrence", "condition_concept_id"),
    ("procedure_occurrence", "procedure_concept_id"),
    ("drug_exposure", "drug_concept_id"),
)


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


class Tables:
    """Named DataFrames over one data folder (or over given frames)."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, frames: dict | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames = dict(frames or {})

    @classmethod
    def from_frames(cls, spark: SparkSession, **frames: DataFrame) -> "Tables":
        return cls(spark, None, frames)

    def raw(self, name: str) -> DataFrame:
        if name not in self._frames:
            if self.sf_dir is None:
                raise KeyError(name)
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        # Only called when normal lookup fails: raw tables by name.
        if name.startswith("_") or name not in RAW_TABLES:
            raise AttributeError(name)
        return self.raw(name)

    def with_frames(self, **frames: DataFrame) -> "Tables":
        """A copy with some views replaced (e.g. an updated concept table)."""
        merged = dict(self._frames)
        merged.update(frames)
        t = Tables(self.spark, self.sf_dir, merged)
        return t

    def _view(self, name: str, build) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = build()
        return self._frames[name]

    # ------------------------------------------------------------------ views
    @property
    def mapper_project(self) -> DataFrame:
        return self._view("mapper_project", lambda: self.raw("region").select(
            (F.col("r_regionkey") + 1).alias("m_project_id"),
            F.col("r_name").alias("m_project_type_id")))

    @property
    def concept(self) -> DataFrame:
        def build():
            s = self.raw("supplier")
            std = s.select(
                (F.col("s_suppkey") + 1).alias("concept_id"),
                F.col("s_name").alias("concept_name"),
                F.lit("Supplier").alias("domain_id"),
                F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("vocabulary_id"),
                F.lit("Supplier").alias("concept_class_id"),
                F.when(F.col("s_suppkey") % 3 < 2, F.lit("S")).alias("standard_concept"),
                F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("concept_code"),
                F.lit(FIXTURE_START).alias("valid_start_date"),
                F.lit(FIXTURE_END).alias("valid_end_date"),
                F.when(F.col("s_suppkey") % 10 == 0, F.lit("D")).alias("invalid_reason"),
                F.lit(None).cast("string").alias("m_language_id"),
                F.lit(None).cast("int").alias("m_project_id"),
            )
            p = self.raw("part")
            local = p.select(
                (F.col("p_partkey") + LOCAL_ID_BASE).alias("concept_id"),
                F.col("p_name").alias("concept_name"),
                F.col("p_type").alias("domain_id"),
                F.col("p_brand").alias("vocabulary_id"),
                F.lit("Part").alias("concept_class_id"),
                F.lit(None).cast("string").alias("standard_concept"),
                F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("concept_code"),
                F.lit(FIXTURE_START).alias("valid_start_date"),
                F.lit(FIXTURE_END).alias("valid_end_date"),
                F.lit(None).cast("string").alias("invalid_reason"),
                F.when(F.col("p_partkey") % 3 == 0, F.lit("FR"))
                 .when(F.col("p_partkey") % 3 == 1, F.lit("EN")).alias("m_language_id"),
                F.when(F.col("p_size") % 6 != 0, F.col("p_size") % 6).cast("int").alias("m_project_id"),
            )
            return std.unionByName(local)
        return self._view("concept", build)

    @property
    def concept_relationship(self) -> DataFrame:
        def build():
            li = self.raw("lineitem").select("l_partkey", "l_suppkey").distinct()
            k = F.col("l_partkey") % 5
            rel = (F.when(k == 0, "Maps to").when(k == 1, "Is a").when(k == 2, "Mapped from")
                   .when(k == 3, "Subsumes")
                   .otherwise(F.when(F.col("l_suppkey") % 2 == 0, "Maps to").otherwise("Subsumes")))
            ended = (F.col("l_partkey") + F.col("l_suppkey")) % 7 == 0
            return li.select(
                (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("m_concept_relationship_id"),
                (F.col("l_partkey") + LOCAL_ID_BASE).alias("concept_id_1"),
                (F.col("l_suppkey") + 1).alias("concept_id_2"),
                rel.alias("relationship_id"),
                F.lit(FIXTURE_START).alias("valid_start_date"),
                F.lit(FIXTURE_END).alias("valid_end_date"),
                F.lit(None).cast("string").alias("invalid_reason"),
                F.when(ended, _ntz(FIXTURE_ENDED_AT)).alias("m_modif_end_datetime"),
                F.when(F.col("l_suppkey") % 2 == 0, F.lit("checked")).alias("m_mapping_comment"),
                ((F.col("l_partkey") + F.col("l_suppkey")) % 5).cast("int").alias("m_mapping_rate"),
            )
        return self._view("concept_relationship", build)

    def _kinds(self, name: str) -> DataFrame:
        """A dictionary table: the distinct values of a concept column, the first concept of each."""
        column = f"{name}_id"
        return self.concept.groupBy(column).agg(F.min("concept_id").alias(f"{name}_concept_id")).select(
            column, F.concat(F.lit(f"{name} "), F.col(column)).alias(f"{name}_name"), f"{name}_concept_id")

    @property
    def domain(self) -> DataFrame:
        return self._view("domain", lambda: self._kinds("domain"))

    @property
    def concept_class(self) -> DataFrame:
        return self._view("concept_class", lambda: self._kinds("concept_class"))

    @property
    def vocabulary(self) -> DataFrame:
        own = F.when(F.col("vocabulary_id").startswith("NATION"), "nation").otherwise("brand")
        return self._view("vocabulary", lambda: self._kinds("vocabulary").select(
            "vocabulary_id", "vocabulary_name", own.alias("vocabulary_reference"),
            F.lit(None).cast("string").alias("vocabulary_version"), "vocabulary_concept_id"))

    @property
    def relationship(self) -> DataFrame:
        def build():
            kind = F.col("relationship_id")
            tree = F.when(kind.isin("Is a", "Subsumes"), "1").otherwise("0")
            reverse = (F.when(kind == "Maps to", "Mapped from").when(kind == "Mapped from", "Maps to")
                       .when(kind == "Is a", "Subsumes").when(kind == "Subsumes", "Is a"))
            found = self.concept_relationship.groupBy("relationship_id").agg(F.min("concept_id_2").alias("relationship_concept_id"))
            return found.select("relationship_id", F.lower(kind).alias("relationship_name"), tree.alias("is_hierarchical"),
                                tree.alias("defines_ancestry"), reverse.alias("reverse_relationship_id"), "relationship_concept_id")
        return self._view("relationship", build)

    @property
    def concept_ancestor(self) -> DataFrame:
        def build():
            up = F.col("relationship_id") == "Is a"
            edges = self.concept_relationship.filter(F.col("relationship_id").isin("Is a", "Subsumes"))
            return edges.select(F.when(up, F.col("concept_id_2")).otherwise(F.col("concept_id_1")).alias("ancestor_concept_id"),
                                F.when(up, F.col("concept_id_1")).otherwise(F.col("concept_id_2")).alias("descendant_concept_id"),
                                F.lit(1).alias("min_levels_of_separation"), F.lit(1).alias("max_levels_of_separation")).distinct()
        return self._view("concept_ancestor", build)

    @property
    def drug_strength(self) -> DataFrame:
        def build():
            amount = lambda c: c.cast("decimal(38,10)")
            none = lambda kind: F.lit(None).cast(kind)
            found = self.raw("lineitem").groupBy("l_partkey", "l_suppkey").agg(
                F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), F.count(F.lit(1)).alias("n"))
            return found.select(
                (F.col("l_partkey") + LOCAL_ID_BASE).alias("drug_concept_id"), (F.col("l_suppkey") + 1).alias("ingredient_concept_id"),
                amount(F.col("lo")).alias("amount_value"), none("long").alias("amount_unit_concept_id"),
                amount(F.col("hi")).alias("numerator_value"), none("long").alias("numerator_unit_concept_id"),
                none("decimal(38,10)").alias("denominator_value"), none("long").alias("denominator_unit_concept_id"),
                F.col("n").cast("int").alias("box_size"), F.lit(FIXTURE_START).alias("valid_start_date"),
                F.lit(FIXTURE_END).alias("valid_end_date"), none("string").alias("invalid_reason"))
        return self._view("drug_strength", build)

    @property
    def concept_synonym(self) -> DataFrame:
        def build():
            p = self.raw("part")
            cid = (F.col("p_partkey") + LOCAL_ID_BASE).alias("concept_id")
            en = p.select(cid, F.concat_ws(" ", "p_name", "p_type").alias("concept_synonym_name"),
                          F.lit(LANG_EN).cast("long").alias("language_concept_id"))
            fr = p.filter(F.col("p_partkey") % 2 == 0).select(
                cid, F.concat_ws(" ", "p_brand", "p_name").alias("concept_synonym_name"),
                F.lit(LANG_FR).cast("long").alias("language_concept_id"))
            own = p.filter(F.col("p_partkey") % 5 == 0).select(
                cid, F.col("p_name").alias("concept_synonym_name"),
                F.lit(LANG_EN).cast("long").alias("language_concept_id"))
            return en.unionByName(fr).unionByName(own)
        return self._view("concept_synonym", build)

    @property
    def mapper_statistic(self) -> DataFrame:
        def build():
            li = self.raw("lineitem")
            per_part = li.groupBy("l_partkey").agg(F.avg("l_quantity").alias("avg_q"),
                                                   F.count(F.lit(1)).alias("ct"))
            audit = [F.lit(1).alias("m_algo_id"), F.lit(1).alias("m_user_id"),
                     _ntz(FIXTURE_STAT_AT).alias("m_valid_start_datetime")]
            avg = per_part.filter(F.col("l_partkey") % 4 != 0).select(
                (F.col("l_partkey") + LOCAL_ID_BASE).alias("m_concept_id"),
                F.lit("AVG").alias("m_statistic_type_id"),
                F.col("avg_q").alias("m_value_as_number"),
                F.lit(None).cast("string").alias("m_value_as_string"), *audit)
            # the three cut points are one scalar subquery (a single sketch result)
            cuts = per_part.agg(F.percentile_approx("ct", [0.75, 0.5, 0.25], 10000)).scalar()
            freq = per_part.select(
                (F.col("l_partkey") + LOCAL_ID_BASE).alias("m_concept_id"),
                F.lit("FREQ").alias("m_statistic_type_id"),
                frequency_class_expr(F.col("ct"), cuts).cast("double").alias("m_value_as_number"),
                F.lit(None).cast("string").alias("m_value_as_string"), *audit)
            ev = self.raw("events")
            cr = self.concept_relationship.select("m_concept_relationship_id", "concept_id_1")
            vote = ev.join(cr, cr.concept_id_1 == ev.user_id + LOCAL_ID_BASE).select(
                F.col("m_concept_relationship_id").alias("m_concept_id"),
                F.lit("VOTE_MAPPING").alias("m_statistic_type_id"),
                F.lit(None).cast("double").alias("m_value_as_number"),
                F.when(F.col("event_type").isin(*UP_EVENTS), "UP").otherwise("DOWN").alias("m_value_as_string"),
                F.lit(1).alias("m_algo_id"),
                F.col("user_id").cast("int").alias("m_user_id"),
                F.col("ts").alias("m_valid_start_datetime"))
            return avg.unionByName(freq).unionByName(vote)
        return self._view("mapper_statistic", build)

    # clinical event tables: one concept column each (plus values for two)
    @property
    def person(self) -> DataFrame:
        return self._view("person", lambda: self.raw("customer").select(
            F.col("c_nationkey").cast("long").alias("gender_concept_id")))

    @property
    def visit_occurrence(self) -> DataFrame:
        return self._view("visit_occurrence", lambda: self.raw("orders").select(
            F.col("o_custkey").cast("long").alias("visit_concept_id")))

    @property
    def visit_detail(self) -> DataFrame:
        return self._view("visit_detail", lambda: self.raw("orders").select(
            (F.col("o_custkey") % 97).cast("long").alias("visit_detail_concept_id")))

    @property
    def observation(self) -> DataFrame:
        return self._view("observation", lambda: self.raw("events").select(
            F.col("user_id").cast("long").alias("observation_concept_id"),
            F.col("value").alias("value_as_number"),
            F.col("props").alias("value_as_string")))

    @property
    def measurement(self) -> DataFrame:
        return self._view("measurement", lambda: self.raw("lineitem").select(
            F.col("l_partkey").cast("long").alias("measurement_concept_id"),
            F.col("l_quantity").alias("value_as_number")))

    @property
    def condition_occurrence(self) -> DataFrame:
        return self._view("condition_occurrence", lambda: self.raw("lineitem").select(
            F.col("l_suppkey").cast("long").alias("condition_concept_id")))

    @property
    def procedure_occurrence(self) -> DataFrame:
        return self._view("procedure_occurrence", lambda: self.raw("events").select(
            F.col("user_id").cast("long").alias("procedure_concept_id")))

    @property
    def drug_exposure(self) -> DataFrame:
        return self._view("drug_exposure", lambda: self.raw("lineitem").select(
            (F.col("l_partkey") % 101).cast("long").alias("drug_concept_id")))

    def event_table(self, name: str) -> DataFrame:
        return getattr(self, name)

    @property
    def project_terms(self) -> DataFrame:
        """Project term list as read from a CSV: all-string columns plus the source order."""
        return self._view("project_terms", lambda: self.raw("part").select(
            F.when(F.col("p_partkey") % 11 != 0, F.col("p_name")).alias("local_concept_name"),
            F.col("p_brand").alias("local_concept_code"),
            F.when(F.col("p_partkey") % 13 != 0, F.col("p_size").cast("string"))
             .otherwise(F.lit("bad")).alias("local_frequency"),
            F.col("p_partkey").alias("src_order")))


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
