"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry runs one operator (or a small composition) of the library over the
whole fixture views of a data folder.  Array columns are rendered as sorted,
'|'-joined strings and floating results are rounded where the two engines may
sum in a different order, so results compare exactly with the SQL twins in
``oracle.py``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions import text
from ..functions.plan_tools import cut_lineage, spread
from ..operators import changes, documents, export, filters, ingest, lexicon, quality, search, stats
from ..operators.segments import Segments
from ..session import ensure_checkpoint_dir
from ..sources.store import Store
from ..sources.tables import LOCAL_ID_BASE, Tables
from ..streaming import refresh

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("concept_documents")
def concept_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return documents.joined_lists(documents.build(t), documents.LIST_COLUMNS)


def _docs_touched_by_votes(t) -> DataFrame:
    """Concepts whose mappings received votes: the ids a user-triggered sync rebuilds."""
    votes = t.mapper_statistic.filter(F.col("m_statistic_type_id") == "VOTE_MAPPING")
    rel = t.concept_relationship.select("m_concept_relationship_id", "concept_id_1")
    return (votes.join(rel, votes.m_concept_id == rel.m_concept_relationship_id, "left_semi")
            .select("m_concept_id")
            .join(rel, F.col("m_concept_id") == F.col("m_concept_relationship_id"))
            .select(F.col("concept_id_1").alias("concept_id")).distinct())


@register("concept_documents_ids")
def concept_documents_ids(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return documents.joined_lists(documents.build(t, ids=_docs_touched_by_votes(t)),
                                  documents.LIST_COLUMNS)


@register("synonyms_by_language")
def synonyms_by_language(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return documents.joined_lists(documents.synonyms(t),
                                  ["concept_synonym_name_en", "concept_synonym_name_fr"])


@register("mapped_names")
def mapped_names(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lists = ["standard_concept_mapped_name", "non_standard_concept_mapped_name", "concept_relation_name",
             "concept_mapped_name_en", "concept_mapped_name_fr"]
    r = documents.relations(t).select(
        "concept_id", *[F.when(F.size(c) > 0, F.col(c)).alias(c) for c in lists])
    return documents.joined_lists(r, lists)


@register("mapping_status")
def mapping_status(spark, sf_dir):
    t = Tables(spark, sf_dir)
    r = documents.relations(t, with_lists=False)
    j = t.concept.select("concept_id").join(r, "concept_id", "left")
    return j.select("concept_id", documents.mapping_status(
        *(F.coalesce(F.col(c), F.lit(0)) for c in ("n_standard", "n_non_standard", "n_relation")))
        .alias("is_mapped"))


@register("local_in_degree")
def local_in_degree(spark, sf_dir):
    return documents.local_in_degree(Tables(spark, sf_dir))


@register("statistic_pivot")
def statistic_pivot(spark, sf_dir):
    return documents.statistics(Tables(spark, sf_dir))


# ----------------------------------------------------------------- statistics
AS_OF = "2025-01-01 00:00:00"


@register("frequency_class")
def frequency_class(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return stats.frequency_class(t, sources=(("measurement", "measurement_concept_id"),))


@register("frequency_class_all_sources")
def frequency_class_all_sources(spark, sf_dir):
    return stats.frequency_class(Tables(spark, sf_dir))


@register("frequency_union")
def frequency_union(spark, sf_dir):
    return stats.frequency_union(stats.frequency_class(Tables(spark, sf_dir)))


@register("frequency_class_collapsed")
def frequency_class_collapsed(spark, sf_dir):
    return stats.frequency_collapsed(stats.frequency_class(Tables(spark, sf_dir)))


@register("value_average_by_source")
def value_average_by_source(spark, sf_dir):
    v = stats.value_sums(Tables(spark, sf_dir))
    return v.select("source", "concept_id", "n", F.round("m_value_avg", 6).alias("m_value_avg"),
                    "value_is_text")


@register("value_average")
def value_average(spark, sf_dir):
    v = stats.value_average(Tables(spark, sf_dir))
    return v.select("concept_id", F.round("m_value_avg", 6).alias("m_value_avg"), "value_is_text")


@register("statistic_upsert")
def statistic_upsert(spark, sf_dir):
    s = stats.refresh_statistics(Tables(spark, sf_dir), AS_OF)
    return s.withColumn("m_value_as_number", F.round("m_value_as_number", 6))


# --------------------------------------------------------------------- export
@register("project_concepts")
def project_concepts(spark, sf_dir):
    return export.project_concepts(Tables(spark, sf_dir))


@register("project_synonyms")
def project_synonyms(spark, sf_dir):
    return export.project_synonyms(Tables(spark, sf_dir))


@register("project_relations")
def project_relations(spark, sf_dir):
    return export.project_relations(Tables(spark, sf_dir))


@register("latest_mapping")
def latest_mapping(spark, sf_dir):
    return export.latest_mapping(Tables(spark, sf_dir))


@register("vote_score")
def vote_score(spark, sf_dir):
    return export.vote_score(Tables(spark, sf_dir))


@register("mapping_pivot")
def mapping_pivot(spark, sf_dir):
    return export.mapping_pivot(Tables(spark, sf_dir))


@register("relation_endpoints")
def relation_endpoints(spark, sf_dir):
    return export.relation_endpoints(Tables(spark, sf_dir))


# --------------------------------------------------------------------- import
# Fixed parameters of the registered import: the term list belongs to project
# type 'EUROPE', French, domain 'Observation', vocabulary 'LOCAL_TERMS'.
IMPORT_ARGS = dict(project_type="EUROPE", language="FR", domain="Observation", vocabulary="LOCAL_TERMS")
IMPORT_DATE = _dt.date(2025, 1, 1)


def _import(t):
    return ingest.import_terms(t.project_terms, **IMPORT_ARGS)


@register("import_valid")
def import_valid(spark, sf_dir):
    good, _, _ = _import(Tables(spark, sf_dir))
    return good


@register("import_rejects")
def import_rejects(spark, sf_dir):
    _, rejects, _ = _import(Tables(spark, sf_dir))
    return rejects


@register("import_report")
def import_report(spark, sf_dir):
    _, _, report = _import(Tables(spark, sf_dir))
    return report


# ---------------------------------------------------------------- maintenance
# Fixed parameters of the registered cascade delete (project type matched without case).
DELETE_ARGS = dict(vocabulary="Brand#3", domain="ECONOMY", project="asia")


def _count(name, df):
    return df.agg(F.count(F.lit(1)).alias("rows_after")).select(F.lit(name).alias("table_name"), "rows_after")


@register("cascade_delete_counts")
def cascade_delete_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    after = changes.cascade_delete(t, **DELETE_ARGS)
    frames = [_count(k, v) for k, v in after.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("insert_concepts")
def insert_concepts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    good, _, _ = _import(t)
    concepts, _ = changes.insert_concepts(t, good, IMPORT_DATE)
    return concepts


@register("insert_statistics")
def insert_statistics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    good, _, _ = _import(t)
    _, st = changes.insert_concepts(t, good, IMPORT_DATE)
    return st


@register("replace_concepts")
def replace_concepts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    good, _, _ = _import(t)
    args = dict(IMPORT_ARGS)
    out = changes.replace_concepts(t, good, args["vocabulary"], args["domain"], args["project_type"],
                                   IMPORT_DATE, mode="overwrite")
    return out["concept"]


def _changed(t):
    """A batch of renames: the local concepts of users who signed up, and the concepts
    those map to."""
    users = (t.events.filter(F.col("event_type") == "signup")
             .select((F.col("user_id") + LOCAL_ID_BASE).alias("concept_id")).distinct())
    targets = (t.concept_relationship.join(users.withColumnRenamed("concept_id", "concept_id_1"),
                                           "concept_id_1", "left_semi")
               .select(F.col("concept_id_2").alias("concept_id")))
    return users.unionByName(targets).distinct()


def _rename(t, changed):
    """Concept table in which the ``changed`` concepts have a revised name."""
    c = t.concept.join(changed.withColumn("_chg", F.lit(True)), "concept_id", "left")
    renamed = c.withColumn("concept_name", F.when(F.col("_chg"), F.concat("concept_name", F.lit(" rev")))
                           .otherwise(F.col("concept_name"))).drop("_chg")
    return renamed.select(*t.concept.columns)


def _renamed(t):
    changed = _changed(t)
    return changed, _rename(t, changed)


@register("document_upsert")
def document_upsert(spark, sf_dir):
    t = Tables(spark, sf_dir)
    old_docs = documents.build(t)
    changed, renamed = _renamed(t)
    t2 = t.with_frames(concept=renamed)
    fresh = documents.build(t2, ids=changes.affected_documents(t2, changed))
    merged = changes.upsert(old_docs, fresh, ["id"])
    return documents.joined_lists(merged, documents.LIST_COLUMNS)


SCD_START = _dt.date(2024, 1, 1)


@register("scd2_merge")
def scd2_merge(spark, sf_dir):
    """Concept history: snapshot 1 = the concept table, snapshot 2 = renames
    applied, deprecated ('D') concepts removed, the imported terms added."""
    t = Tables(spark, sf_dir)
    cols = [c for c in t.concept.columns if c not in ("valid_start_date", "valid_end_date")]
    hist = t.concept.select(*cols, F.lit(SCD_START).alias("valid_start_date"),
                            F.lit(changes.OPEN_END).alias("valid_end_date"))
    _, renamed = _renamed(t)
    good, _, _ = _import(t)
    new_concepts, _ = changes.insert_concepts(t, good, IMPORT_DATE)
    snap = (renamed.filter(F.col("invalid_reason").isNull() | (F.col("invalid_reason") != "D"))
            .select(*cols).unionByName(new_concepts.select(*cols)))
    return changes.scd2(hist, snap, ["concept_id"], "valid_start_date", "valid_end_date", IMPORT_DATE)


# ----------------------------------------------------------------------- text
def _doc_tokens(spark, sf_dir, lang):
    docs = spread(Tables(spark, sf_dir).documents.filter(F.col("lang") == lang))
    return text.token_rows(docs, "text", lang, keep=["doc_id"])


@register("tokens_en")
def tokens_en(spark, sf_dir):
    return _doc_tokens(spark, sf_dir, "en")


@register("tokens_fr")
def tokens_fr(spark, sf_dir):
    return _doc_tokens(spark, sf_dir, "fr")


@register("tokens_de")
def tokens_de(spark, sf_dir):
    return _doc_tokens(spark, sf_dir, "de")


@register("tokens_es")
def tokens_es(spark, sf_dir):
    return _doc_tokens(spark, sf_dir, "es")


@register("path_hierarchy")
def path_hierarchy(spark, sf_dir):
    pages = Tables(spark, sf_dir).pages
    return pages.select("page_id", F.posexplode(text.path_prefixes(text.url_path(F.col("url"))))
                        .alias("level", "prefix")).withColumn("level", F.col("level") + 1)


# ------------------------------------------------------------------ retrieval
_INDEXES: dict[tuple[str, str], dict] = {}


def input_fingerprint(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Count and combined hash of the names, sizes and modification times of all files
    below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir)
    return tuple(files.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


def _persisted(spark: SparkSession, sf_dir: str, *parts: str) -> list:
    """Parts of the index of a data folder.  Each is built and written when a query first
    needs it, once for an application and state of the folder's files:
    ``docs`` concept documents, ``positions`` token places, ``index`` the BM25 index,
    ``lists`` the positional lists of the phrase matcher."""
    key = (spark.sparkContext.applicationId, sf_dir)
    state = input_fingerprint(spark, sf_dir)
    if _INDEXES.get(key, {}).get("state") != state:
        _INDEXES[key] = {"state": state}
    have = _INDEXES[key]

    def part(name: str):
        if name not in have:
            have[name] = build[name]()
        return have[name]

    build = {"docs": lambda: cut_lineage(documents.build(Tables(spark, sf_dir)), "documents"),
             "positions": lambda: search.positional_postings(part("docs")),
             "index": lambda: cut_lineage(search.index(part("docs"), positions=part("positions")), "index"),
             "lists": lambda: search.phrase_lists(part("positions"))}
    return [part(name) for name in parts]


def persisted_documents(spark: SparkSession, sf_dir: str):
    """(tables, documents) of a data folder."""
    return Tables(spark, sf_dir), *_persisted(spark, sf_dir, "docs")


def persisted_index(spark: SparkSession, sf_dir: str):
    """(tables, documents, token places, index) of a data folder, read by every retrieval query."""
    return Tables(spark, sf_dir), *_persisted(spark, sf_dir, "docs", "positions", "index")


def _search_inputs(spark, sf_dir):
    """Concept documents, their BM25 index, and the labels to map: the validated
    project terms (label = term name, value = its local frequency)."""
    t, docs, _, idx = persisted_index(spark, sf_dir)
    good, _, _ = _import(t)
    labels = good.select(F.col("src_order").alias("query_id"), F.col("concept_name").alias("text"),
                         F.col("m_value_as_number").alias("value_avg"),
                         F.col("m_value_as_number").alias("frequency"))
    return t, docs, idx, labels


def _ranked(spark, sf_dir, **kw):
    _, docs, idx, labels = _search_inputs(spark, sf_dir)
    out = search.rank(labels, idx, docs, **kw)
    return out.withColumn("score", F.round("score", 6))


# The filters of the registered search with a filter for each label.
LABEL_FILTERS = [
    (1, 1, False, "enum", "standard_concept", "OMOP S", None, None), (1, 1, False, "enum", "standard_concept", "ASIA EMPTY", None, None),
    (1, 2, True, "enum", "invalid_reason", "OMOP D", None, None),
    (2, 1, False, "num", "frequency", None, 2.0, 3.0), (2, 1, False, "num", "value_avg", None, 30.0, None),
    (3, 1, False, "text", "concept_name_en", "Plates", None, None), (3, 1, False, "text", "concept_name_en", "blue", None, None),
    (3, 2, True, "enum", "is_mapped", "ASIA S", None, None), (3, 2, True, "num", "frequency", None, None, 1.0),
]


# The filter of the registered filtered search (mapped concepts only).
MAPPED_FILTER = r" N?S$"


@register("postings")
def postings(spark, sf_dir):
    _, _, _, ix = persisted_index(spark, sf_dir)
    return ix.select("concept_id", "field", "token", "tf", "dl", "df", F.round("bm25", 9).alias("bm25"))


@register("search_simple")
def search_simple(spark, sf_dir):
    return _ranked(spark, sf_dir)


@register("search_weighted")
def search_weighted(spark, sf_dir):
    return _ranked(spark, sf_dir, weights=search.WEIGHTS_NAME2)


@register("search_weighted_5_3")
def search_weighted_5_3(spark, sf_dir):
    return _ranked(spark, sf_dir, weights=search.WEIGHTS_5_3)


@register("search_value_boost")
def search_value_boost(spark, sf_dir):
    return _ranked(spark, sf_dir, boost="value")


@register("search_frequency_boost")
def search_frequency_boost(spark, sf_dir):
    return _ranked(spark, sf_dir, boost="frequency")


@register("search_numerics_boost")
def search_numerics_boost(spark, sf_dir):
    return _ranked(spark, sf_dir, boost="numerics")


@register("search_filtered")
def search_filtered(spark, sf_dir):
    return _ranked(spark, sf_dir, doc_filter=F.col("is_mapped").rlike(MAPPED_FILTER))


@register("search_label_filters")
def search_label_filters(spark, sf_dir):
    """Each label with a filter of its own: by turns none, a set of values, two ranges of
    which one must hold, and a word of the name without a set of values."""
    _, docs, idx, labels = _search_inputs(spark, sf_dir)
    return filters.rank_filtered(labels.withColumn("filter_id", F.col("query_id") % 4), idx, docs,
                                 spark.createDataFrame(LABEL_FILTERS, filters.LITERALS)).withColumn("score", F.round("score", 6))


@register("search_page")
def search_page(spark, sf_dir):
    return _ranked(spark, sf_dir, k=10, page=2)


@register("search_counts")
def search_counts(spark, sf_dir):
    _, docs, idx, labels = _search_inputs(spark, sf_dir)
    return search.hit_counts(labels, idx, docs)


@register("facets")
def facets(spark, sf_dir):
    _, docs, idx, labels = _search_inputs(spark, sf_dir)
    return search.facets(labels, idx, docs, ["standard_concept", "is_mapped"], n=10)


# -------------------------------------------------------------------- lexicon
# A small French -> English word lexicon (word, lemma, rank) used
# by the word-by-word translation of the French documents.
FR_EN_WORDS = [
    ("le", "the", 1), ("la", "the", 1), ("les", "the", 1), ("un", "a", 1), ("une", "a", 1),
    ("des", "some", 1), ("du", "of the", 1), ("de", "of", 1), ("de", "from", 2), ("et", "and", 1),
    ("en", "in", 1), ("dans", "in", 1), ("pour", "for", 1), ("par", "by", 1), ("sur", "on", 1),
    ("avec", "with", 1), ("qui", "who", 1), ("elle", "she", 1), ("il", "he", 1), ("au", "at the", 1),
]
CODE_DATE = _dt.date(2025, 1, 1)


def _local_codes(t):
    """Local code list: each local concept with code 'K' + part key mod 300."""
    return t.part.select((F.col("p_partkey") + LOCAL_ID_BASE).alias("concept_id"),
                         F.concat(F.lit("K"), (F.col("p_partkey") % 300).cast("string")).alias("concept_code"),
                         F.col("p_name").alias("lib"))


def _standard_codes(t):
    """Standard code list with dotted codes: 'K.' + supplier key."""
    return t.supplier.select((F.col("s_suppkey") + 1).alias("concept_id"),
                             F.concat(F.lit("K."), F.col("s_suppkey").cast("string")).alias("concept_code"))


@register("synonym_groups")
def synonym_groups(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    return lexicon.groups(part.select(F.col("p_type").alias("_c0"), F.col("p_name").alias("_c1")))


@register("bilingual_lexicon")
def bilingual_lexicon(spark, sf_dir):
    """fr -> en lexicon from parallel labels: the French and English synonyms of
    the same concept (the concept's own name ranked after its longer label)."""
    t = Tables(spark, sf_dir)
    syn = t.concept_synonym
    fr = syn.filter(F.col("language_concept_id") == 4180190).select("concept_id", F.col("concept_synonym_name").alias("fr"))
    en = syn.filter(F.col("language_concept_id") == 4180186).join(
        t.concept.select("concept_id", "concept_name"), "concept_id").select(
        "concept_id", F.col("concept_synonym_name").alias("en"),
        F.when(F.col("concept_synonym_name") == F.col("concept_name"), 2).otherwise(1).alias("rank"))
    return lexicon.bilingual(fr.join(en, "concept_id")).select("word", "rule")


@register("translate_words")
def translate_words(spark, sf_dir):
    t = Tables(spark, sf_dir)
    docs = spread(t.documents.filter(F.col("lang") == "fr").select("doc_id", "text"))
    lex = spark.createDataFrame(FR_EN_WORDS, "word string, lemma string, rank int")
    return lexicon.translate(docs, "doc_id", "text", lex)


@register("translation_batches")
def translation_batches(spark, sf_dir):
    c = Tables(spark, sf_dir).concept
    labels = c.select(F.col("vocabulary_id").alias("bucket"), F.col("concept_code").alias("cd"),
                      F.col("concept_name").alias("lib"))
    return lexicon.batches(labels, "bucket", ["lib", "cd"])


@register("code_mapping")
def code_mapping(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return lexicon.map_codes(_local_codes(t), _standard_codes(t))


@register("bidirectional_edges")
def bidirectional_edges(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return lexicon.both_directions(lexicon.map_codes(_local_codes(t), _standard_codes(t)), CODE_DATE)


@register("two_hop")
def two_hop(spark, sf_dir):
    t = Tables(spark, sf_dir)
    first = lexicon.both_directions(lexicon.map_codes(_local_codes(t), _standard_codes(t)), CODE_DATE)
    live = t.concept_relationship.filter(F.col("m_modif_end_datetime").isNull())
    return lexicon.two_hop(first, live)


@register("code_list_concepts")
def code_list_concepts(spark, sf_dir):
    codes = _local_codes(Tables(spark, sf_dir)).select(F.col("concept_code").alias("cd"), "lib")
    return lexicon.code_list_concepts(codes, CODE_DATE)


# -------------------------------------------------------------------- quality
@register("quality_duplicates")
def quality_duplicates(spark, sf_dir):
    return quality.duplicates(Tables(spark, sf_dir))


@register("quality_orphans")
def quality_orphans(spark, sf_dir):
    return quality.orphans(Tables(spark, sf_dir))


@register("quality_checks")
def quality_checks(spark, sf_dir):
    return quality.checks(Tables(spark, sf_dir))


# ------------------------------------------------------------------ streaming
@register("stream_refresh")
def stream_refresh(spark, sf_dir):
    """Change feed -> incremental refresh of the document store.

    The store starts as the full build; the concepts renamed by a batch of
    changes arrive as feed files (several micro-batches); after the stream has
    drained the feed the store must equal a full rebuild over the renamed
    tables.  All files go under the session's checkpoint folder."""
    root, feed, before, after = _change_feed(spark, Tables(spark, sf_dir))
    refresh.initialise_store(before, f"{root}/store")
    q = refresh.refresh(spark, feed, after, f"{root}/store", f"{root}/checkpoint", max_files_per_trigger=1)
    q.awaitTermination()
    return documents.joined_lists(Store(spark, f"{root}/store", "id").read(), documents.LIST_COLUMNS)


def _written(t):
    """Tables with the edges, and the statistics that documents show, written once: every
    micro-batch reads them several times, and as views they would be computed each time."""
    shown = t.mapper_statistic.filter(F.col("m_statistic_type_id").isin("AVG", "FREQ"))
    t = t.with_frames(mapper_statistic=cut_lineage(shown, "statistics"))
    return t.with_frames(concept_relationship=cut_lineage(t.concept_relationship, "edges"))


def _change_feed(spark, t):
    """Folder, feed folder and the tables before and after the changes, which come in two files."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/termspark-stream-{uuid.uuid4().hex}"
    t = _written(t)
    changed = cut_lineage(_changed(t), "changed")
    changed.repartitionByRange(2, "concept_id").write.parquet(f"{root}/feed")
    return root, f"{root}/feed", t, t.with_frames(concept=cut_lineage(_rename(t, changed), "renamed"))


@register("index_refresh")
def index_refresh(spark, sf_dir):
    """The same changes taken into the search index, a segment for each micro-batch: its
    postings must be those of an index built anew over the renamed tables."""
    t, docs = persisted_documents(spark, sf_dir)
    root, feed, _, after = _change_feed(spark, t)
    index = Segments(spark, f"{root}/index")
    index.build(docs)
    q = refresh.refresh(spark, feed, after, None, f"{root}/checkpoint", f"{root}/index", max_files_per_trigger=1)
    q.awaitTermination()
    return index.index().select("concept_id", "field", "token", "tf", "dl", "df", F.round("bm25", 9).alias("bm25"))


@register("search_phrase")
def search_phrase(spark, sf_dir):
    """Labels = the three-word English synonyms (whole table); term score plus
    the pf3 phrase boost (slop 2, name 6 / synonym 3 / mapped 3)."""
    t = Tables(spark, sf_dir)
    lists, idx = _persisted(spark, sf_dir, "lists", "index")
    labels = (t.concept_synonym.filter(F.col("language_concept_id") == 4180186)
              .join(t.concept.select("concept_id", "concept_name").hint("merge"), "concept_id")
              .filter(F.col("concept_synonym_name") != F.col("concept_name"))
              .select(F.col("concept_id").alias("query_id"), F.col("concept_synonym_name").alias("text")))
    out = search.rank_with_phrases(labels, idx, *lists)
    return out.withColumn("score", F.round("score", 6))


@register("highlight")
def highlight(spark, sf_dir):
    _, docs, idx, labels = _search_inputs(spark, sf_dir)
    top = search.rank(labels, idx, docs)
    return search.highlight(top, labels, docs)


# ------------------------------------------------------ query-time expansion
@register("synonym_expand")
def synonym_expand(spark, sf_dir):
    """Validated project labels expanded with the synonym groups of the
    type dictionary (every name of a type is a synonym of the others)."""
    t = Tables(spark, sf_dir)
    good, _, _ = _import(t)
    labels = good.select(F.col("src_order").alias("query_id"), F.col("concept_name").alias("text"))
    dic = t.part.select(F.col("p_type").alias("_c0"), F.col("p_name").alias("_c1"))
    members = lexicon.group_members(dic)
    return search.expand_tokens(labels, "query_id", "text", "en", groups=members)


@register("crosslingual_expand")
def crosslingual_expand(spark, sf_dir):
    """French labels (the French synonyms) rewritten with the fr -> en lexicon
    built from parallel labels, analysed with the fr_en chain."""
    t = Tables(spark, sf_dir)
    syn = t.concept_synonym
    fr = syn.filter(F.col("language_concept_id") == 4180190)
    # merge: both sides grow with the concepts and would be broadcast by their size on disk
    en = syn.filter(F.col("language_concept_id") == 4180186).join(
        t.concept.select("concept_id", "concept_name").hint("merge"), "concept_id").filter(
        F.col("concept_synonym_name") != F.col("concept_name"))
    rules = fr.select("concept_id", F.col("concept_synonym_name").alias("term")).join(
        en.select("concept_id", F.col("concept_synonym_name").alias("replacement")).hint("merge"), "concept_id").select(
        "term", "replacement").distinct()
    labels = fr.select(F.col("concept_id").alias("query_id"), F.col("concept_synonym_name").alias("text"))
    return search.expand_tokens(labels, "query_id", "text", "fr_en", rewrites=rules)


@register("search_expanded")
def search_expanded(spark, sf_dir):
    """Validated project labels ranked in the English fields after query-time
    expansion with the synonym groups of the type dictionary."""
    t, docs, idx, labels = _search_inputs(spark, sf_dir)
    dic = t.part.select(F.col("p_type").alias("_c0"), F.col("p_name").alias("_c1"))
    members = lexicon.group_members(dic)
    out = search.rank_expanded(labels.select("query_id", "text"), idx, groups=members)
    return out.withColumn("score", F.round("score", 6))


from . import registry_io  # noqa: E402,F401  (registers its queries)
