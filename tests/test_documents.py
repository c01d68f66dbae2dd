"""Document build semantics on inline frames (null, empty and malformed cases)."""

from frames import concept, rel, tables

from termspark.operators import documents


def docs(t):
    return {r.concept_id: r for r in documents.build(t).collect()}


def test_mapping_status_and_lists(spark):
    t = tables(spark, [
        concept(1, "std target", std="S"), concept(2, "ns target"), concept(3, "fr target", lang="FR"),
        concept(2000000001, "local a", project=1), concept(2000000002, "local b", project=1),
        concept(2000000003, "local c"), concept(2000000004, "local d"), concept(2000000005, "self")],
        rels=[rel(2000000001, 1), rel(2000000001, 2, "Is a"),            # S wins
              rel(2000000002, 2, "maps to"), rel(2000000002, 3, "Mapped from"),  # NS (case-insensitive kind)
              rel(2000000003, 1, "Subsumes"),                            # R
              rel(2000000004, 1, ended=True), rel(2000000004, 99),       # ended edge, missing target -> EMPTY
              rel(2000000005, 2000000005)])                               # self loop ignored
    d = docs(t)
    assert d[2000000001].is_mapped == "NORTH S"
    assert d[2000000002].is_mapped == "NORTH NS"
    assert d[2000000003].is_mapped == "OMOP R"
    assert d[2000000004].is_mapped == "OMOP EMPTY"
    assert d[2000000005].is_mapped == "OMOP EMPTY"
    assert sorted(d[2000000001].concept_mapped_name_en) == ["ns target", "std target"]
    assert d[2000000002].concept_mapped_name_fr == ["fr target"]
    assert d[2000000002].concept_mapped_name_fr_en == ["fr target"]
    assert d[2000000003].concept_mapped_name_en is None       # 'subsumes' is not an equivalence
    assert d[2000000004].concept_mapped_name_en is None       # empty list -> null
    # in-degree from local concepts over live edges only
    assert d[1].local_map_number == 2 and d[2].local_map_number == 2 and d[3].local_map_number == 1


def test_language_routing_and_defaults(spark):
    t = tables(spark, [concept(1, "n1", lang=None), concept(2, "n2", lang="EN"), concept(3, "n3", lang="FR"),
                       concept(4, None, project=1)])
    d = docs(t)
    assert (d[1].concept_name_en, d[1].concept_name_fr) == ("n1", None)
    assert (d[2].concept_name_en, d[2].m_language_id) == ("n2", "OMOP EN")
    assert (d[3].concept_name_fr, d[3].concept_name_fr_en, d[3].concept_name_en) == ("n3", "n3", None)
    assert d[4].concept_name == "EMPTY" and d[4].standard_concept == "NORTH EMPTY"
    assert d[1].value_is_numeric is False and d[1].frequency is None


def test_synonyms_exclude_own_name(spark):
    t = tables(spark, [concept(1, "heart")],
               syns=[(1, "heart", 4180186), (1, "cardiac", 4180186), (1, "coeur", 4180190)])
    d = docs(t)[1]
    assert d.concept_synonym_name_en == ["cardiac"]
    assert d.concept_synonym_name_fr == ["coeur"] and d.concept_synonym_name_fr_en == ["coeur"]


def test_ids_restrict_output_only(spark):
    t = tables(spark, [concept(1, "target", std="S"), concept(2000000001, "a"), concept(2000000002, "b")],
               rels=[rel(2000000001, 1), rel(2000000002, 1)])
    ids = spark.createDataFrame([(1,)], "concept_id long")
    out = documents.build(t, ids=ids).collect()
    assert [r.concept_id for r in out] == [1]
    assert out[0].local_map_number == 2  # counted over whole tables


def test_statistics_pivot(spark):
    t = tables(spark, [concept(1, "x")], stats=[(1, "AVG", 2.5, None, 1, 1, None), (1, "FREQ", 3.0, None, 1, 1, None),
                                                (1, "VOTE_MAPPING", None, "UP", 1, 1, None)])
    d = docs(t)[1]
    assert (d.value_avg, d.frequency, d.value_is_numeric) == (2.5, 3, True)
