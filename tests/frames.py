"""Small inline terminology tables for unit tests."""

import datetime as dt

from termspark.sources.tables import Tables

D0, D1 = dt.date(2000, 1, 1), dt.date(2099, 12, 31)

CONCEPT = ("concept_id long, concept_name string, domain_id string, vocabulary_id string, concept_class_id string, "
           "standard_concept string, concept_code string, valid_start_date date, valid_end_date date, "
           "invalid_reason string, m_language_id string, m_project_id int")
REL = ("m_concept_relationship_id long, concept_id_1 long, concept_id_2 long, relationship_id string, "
       "valid_start_date date, valid_end_date date, invalid_reason string, m_modif_end_datetime timestamp_ntz, "
       "m_mapping_comment string, m_mapping_rate int")
SYN = "concept_id long, concept_synonym_name string, language_concept_id long"
STAT = ("m_concept_id long, m_statistic_type_id string, m_value_as_number double, m_value_as_string string, "
        "m_algo_id int, m_user_id int, m_valid_start_datetime timestamp_ntz")
PROJ = "m_project_id int, m_project_type_id string"


def concept(cid, name, std=None, lang=None, project=None, code=None, vocab="V", domain="D", invalid=None):
    return (cid, name, domain, vocab, "C", std, code or f"c{cid}", D0, D1, invalid, lang, project)


def rel(c1, c2, kind="Maps to", ended=False, rid=None):
    return (rid or c1 * 1000 + c2, c1, c2, kind, D0, D1, None,
            dt.datetime(2024, 1, 1) if ended else None, None, None)


def tables(spark, concepts, rels=(), syns=(), stats=(), projects=((1, "NORTH"),)):
    return Tables.from_frames(
        spark,
        concept=spark.createDataFrame(list(concepts), CONCEPT),
        concept_relationship=spark.createDataFrame(list(rels), REL),
        concept_synonym=spark.createDataFrame(list(syns), SYN),
        mapper_statistic=spark.createDataFrame(list(stats), STAT),
        mapper_project=spark.createDataFrame(list(projects), PROJ),
    )
