"""Registered DuckDB twins: name -> SQL over the pre-registered driver tables."""

from __future__ import annotations

import functools

from .registry import FR_EN_WORDS

from . import oracle_changes as oc
from . import oracle_documents as od
from . import oracle_lexicon as ol
from . import oracle_export as oe
from . import oracle_io as oio
from . import oracle_search as osr
from . import oracle_stats as os_
from . import oracle_text as ot


@functools.lru_cache(maxsize=1)
def twins() -> dict[str, str]:
    """Built on the first call, so that importing the queries builds no SQL."""
    return {
        "concept_documents": od.concept_documents(),
        "concept_documents_ids": od.concept_documents_ids(),
        "synonyms_by_language": od.synonyms_by_language(),
        "mapped_names": od.mapped_names(),
        "mapping_status": od.mapping_status(),
        "local_in_degree": od.local_in_degree(),
        "statistic_pivot": od.statistic_pivot(),
        "frequency_class": os_.frequency_class_one(),
        "frequency_class_all_sources": os_.frequency_class_all(),
        "frequency_union": os_.frequency_union(),
        "frequency_class_collapsed": os_.frequency_collapsed(),
        "value_average_by_source": os_.value_average_by_source(),
        "value_average": os_.value_average(),
        "statistic_upsert": os_.statistic_upsert(),
        "project_concepts": oe.project_concepts(),
        "project_synonyms": oe.project_synonyms(),
        "project_relations": oe.project_relations(),
        "latest_mapping": oe.latest_mapping(),
        "vote_score": oe.vote_score(),
        "mapping_pivot": oe.mapping_pivot(),
        "relation_endpoints": oe.relation_endpoints(),
        "import_valid": oc.import_valid(),
        "import_rejects": oc.import_rejects(),
        "import_report": oc.import_report(),
        "cascade_delete_counts": oc.cascade_delete_counts(),
        "insert_concepts": oc.insert_concepts(),
        "insert_statistics": oc.insert_statistics(),
        "replace_concepts": oc.replace_concepts(),
        "document_upsert": oc.document_upsert(),
        "scd2_merge": oc.scd2_merge(),
        "stream_refresh": oc.document_upsert(),
        "tokens_en": ot.tokens("en"),
        "tokens_fr": ot.tokens("fr"),
        "tokens_de": ot.tokens("de"),
        "tokens_es": ot.tokens("es"),
        "path_hierarchy": ot.path_hierarchy(),
        "postings": osr.postings(),
        "search_label_filters": osr.search_label_filters(),
        "index_refresh": osr.index_refresh(),
        "search_simple": osr.search(),
        "search_weighted": osr.search(weights={"concept_name": 2.0, "concept_synonym_name": 1.0,
                                               "concept_mapped_name": 1.0}),
        "search_weighted_5_3": osr.search(weights={"concept_name": 5.0, "concept_synonym_name": 3.0}),
        "search_value_boost": osr.search(boost="value"),
        "search_frequency_boost": osr.search(boost="frequency"),
        "search_numerics_boost": osr.search(boost="numerics"),
        "search_filtered": osr.search(doc_filter="regexp_matches(d.is_mapped, ' N?S$')"),
        "search_page": osr.search(page=2),
        "search_counts": osr.hit_counts(),
        "facets": osr.facets(),
        "search_phrase": osr.search_phrase(),
        "highlight": osr.highlight(),
        "synonym_expand": osr.synonym_expand(),
        "crosslingual_expand": osr.crosslingual_expand(),
        "search_expanded": osr.search_expanded(),
        "synonym_groups": ol.synonym_groups(),
        "bilingual_lexicon": ol.bilingual_lexicon(),
        "translate_words": ol.translate_words(FR_EN_WORDS),
        "translation_batches": ol.translation_batches(),
        "code_mapping": ol.code_mapping(),
        "bidirectional_edges": ol.bidirectional_edges(),
        "two_hop": ol.two_hop(),
        "code_list_concepts": ol.code_list_concepts(),
        "quality_duplicates": ol.quality_duplicates(),
        "quality_orphans": ol.quality_orphans(),
        "quality_checks": ol.quality_checks(),
        **oio.twins(),
    }
