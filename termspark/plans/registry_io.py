"""Registered queries of the readers, writers and token forms: each writes data that
Spark derives from the given tables, reads it back with the library's reader, and
returns what came back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import changes, export, lexicon, quality, search
from ..session import ensure_checkpoint_dir
from ..sources import readers, writers
from ..sources.tables import LANG_EN, LANG_FR, Tables
from .registry import CODE_DATE, _local_codes, persisted_index, register


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/termspark-{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------ write, then read
@register("csv_round_trip")
def csv_round_trip(spark, sf_dir):
    out = _folder(spark, "csv")
    part = Tables(spark, sf_dir).part.select("p_partkey", "p_name", "p_type", "p_size")
    writers.write_csv(part, out, header=True)
    good, _ = readers.read_csv_strict(spark, out)
    return good


@register("text_round_trip")
def text_round_trip(spark, sf_dir):
    out = _folder(spark, "text")
    writers.write_text(Tables(spark, sf_dir).part.select("p_name"), out)
    return spark.read.text(out)


@register("table_copy")
def table_copy(spark, sf_dir):
    """ORC table, copied whole."""
    out = _folder(spark, "orc")
    writers.write_orc(Tables(spark, sf_dir).supplier.select("s_suppkey", "s_name", "s_nationkey"), f"{out}/a")
    return writers.copy_table(spark, f"{out}/a", f"{out}/b", fmt="orc")


@register("bulk_append")
def bulk_append(spark, sf_dir):
    """Two appends of four writers each: customers, then suppliers."""
    t, out = Tables(spark, sf_dir), _folder(spark, "append")
    writers.append_bulk(t.customer.select(F.lit("c").alias("kind"), F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation")), out, 4)
    writers.append_bulk(t.supplier.select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("nation")), out, 4)
    return spark.read.parquet(out)


@register("project_csv")
def project_csv(spark, sf_dir):
    """Per-project CSV folders of the exported concepts."""
    out = _folder(spark, "project-csv")
    writers.write_per_project_csv(export.project_concepts(Tables(spark, sf_dir)), out)
    back = spark.read.option("header", "true").csv(out)
    return back.select("concept_id", "concept_name", "concept_code", F.col("m_project_type_id").cast("string").alias("m_project_type_id"))


@register("import_control_report")
def import_control_report(spark, sf_dir):
    """Control-file import of two term files, one without the optional frequency column
    and one file that the control table switches off."""
    t, out = Tables(spark, sf_dir), _folder(spark, "import")
    terms = t.project_terms
    writers.write_csv(terms.filter("src_order % 2 = 0").drop("src_order"), f"{out}/europe/a.csv", header=True)
    writers.write_csv(terms.filter("src_order % 2 = 1").select("local_concept_name", "local_concept_code"), f"{out}/asia/b.csv", header=True)
    control = spark.createDataFrame(
        [(1, "a.csv", "EUROPE", "Observation", "LOCAL_TERMS", "FR", "overwrite", ",", '"'),
         (1, "b.csv", "ASIA", "Observation", "LOCAL_TERMS", "EN", "overwrite", ",", '"'),
         (0, "none.csv", "ASIA", "Observation", "LOCAL_TERMS", "EN", "overwrite", ",", '"')],
        "active int, file string, project string, domain string, vocabulary string, language string, mode string, sep string, quote string")
    good, _, report, _ = readers.import_from_control(spark, control, out)
    kept = good.groupBy(F.concat(F.lit("good:"), "m_project_type_id").alias("check")).agg(F.count(F.lit(1)).alias("bad_rows"))
    return report.unionByName(kept).select("check", F.col("bad_rows").alias("n"))


@register("tab_pairs")
def tab_pairs(spark, sf_dir):
    """Tab dictionary read back into synonym groups."""
    out = _folder(spark, "tab")
    Tables(spark, sf_dir).part.select("p_type", "p_name").write.option("sep", "\t").csv(out)
    return lexicon.groups(readers.read_tab_pairs(spark, out))


@register("code_list_csv")
def code_list_csv(spark, sf_dir):
    """Code list file (cd, lib) loaded as concepts."""
    out = _folder(spark, "codes")
    writers.write_csv(_local_codes(Tables(spark, sf_dir)).select(F.col("concept_code").alias("cd"), "lib"), out, header=True)
    return lexicon.code_list_concepts(readers.read_codes(spark, out), CODE_DATE)


@register("vocabulary_snapshot")
def vocabulary_snapshot(spark, sf_dir):
    """Vocabulary release written as delimited files, loaded typed and published: all rows
    of the nine tables of the current snapshot, each as one text."""
    t, out = Tables(spark, sf_dir), _folder(spark, "vocabulary")
    for name in readers.VOCABULARY_SCHEMAS:
        sep, quote = readers.VOCABULARY_FORMATS[name]
        (getattr(t, name).select(*quality.columns(name)).write
         .options(header="true", sep=sep, quote=quote, dateFormat="yyyyMMdd").csv(f"{out}/src/{name.upper()}.csv"))
    readers.load_vocabulary(spark, f"{out}/src", f"{out}/db", "v1")
    rows = None
    for name, table in readers.current_vocabulary(spark, f"{out}/db").items():
        shown = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in quality.columns(name)])
        own = table.select(F.lit(name).alias("table_name"), shown.alias("content"))
        rows = own if rows is None else rows.unionByName(own)
    return rows


@register("align_schema")
def align_schema(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    return changes.align(part, "p_partkey long, p_name string, p_note string, p_size long")


@register("synonym_rules")
def synonym_rules(spark, sf_dir):
    """Synonym rule file: groups from the type dictionary, rewrites from brand to type."""
    t, out = Tables(spark, sf_dir), _folder(spark, "rules")
    members = lexicon.group_members(t.part.select(F.col("p_type").alias("_c0"), F.col("p_name").alias("_c1")))
    lines = members.groupBy("group_key").agg(F.concat_ws(", ", F.array_sort(F.collect_list("member"))).alias("value")).select("value")
    arrows = t.part.select(F.concat(F.translate("p_brand", "#", "_"), F.lit(" => "), "p_type", F.lit("  # from brand")).alias("value")).distinct()
    writers.write_text(lines.unionByName(arrows).unionByName(spark.range(1).select(F.lit("# a comment").alias("value"))), out)
    groups, rewrites = readers.read_synonym_rules(spark, out)
    n = groups.groupBy("group_key").agg(F.count(F.lit(1)).alias("n"), F.min("member").alias("member"))
    return (n.select(F.lit("group").alias("kind"), F.col("member").alias("term"), F.col("n").cast("string").alias("value"))
            .unionByName(rewrites.select(F.lit("rewrite").alias("kind"), "term", F.col("replacement").alias("value"))))


# ------------------------------------------------------------------ token forms
@register("tokens_lower")
def tokens_lower(spark, sf_dir):
    return Tables(spark, sf_dir).part.select("p_partkey", F.lower("p_type").alias("value"))


@register("tokens_whitespace")
def tokens_whitespace(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    toks = text.whitespace_tokens(F.col("text"))
    return docs.select("doc_id", F.size(toks).alias("n"), F.size(text.distinct_tokens(toks)).alias("n_distinct"))


@register("tokens_reversed")
def tokens_reversed(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    return part.select("p_partkey", F.array_join(text.reversed_tokens(text.whitespace_tokens(F.col("p_name"))), "|").alias("value"))


@register("tokens_delimiter")
def tokens_delimiter(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    raw = F.concat_ws(" ", "p_brand", F.concat(F.initcap("p_name"), F.lit("Lot"), F.col("p_size").cast("string")))
    return part.select("p_partkey", F.array_join(text.word_delimiter(F.regexp_replace(raw, "([a-z]) ([A-Z])", "$1$2")), "|").alias("value"))


@register("tokens_payload")
def tokens_payload(spark, sf_dir):
    part = Tables(spark, sf_dir).part
    raw = F.concat_ws(" ", F.concat(F.lit("size|"), F.col("p_size").cast("string")), "p_type")
    return (part.select("p_partkey", F.posexplode(text.payload_tokens(raw)).alias("pos", "x"))
            .select("p_partkey", "pos", "x.token", F.col("x.payload").cast("double").alias("payload")))


# -------------------------------------------------------------------- retrieval
@register("match_all")
def match_all(spark, sf_dir):
    """Labels without text: every document matches."""
    t = Tables(spark, sf_dir)
    return search.match_all(t.concept, t.part.select(F.col("p_partkey").alias("query_id")))


@register("search_by_language")
def search_by_language(spark, sf_dir):
    """Each concept's English and French label, sent to the field groups of its language."""
    t, _, _, idx = persisted_index(spark, sf_dir)
    syn = t.concept_synonym
    fr = syn.filter(F.col("language_concept_id") == LANG_FR).select("concept_id", F.col("concept_synonym_name").alias("text_fr"))
    en = (syn.filter(F.col("language_concept_id") == LANG_EN).join(t.concept.select("concept_id", "concept_name"), "concept_id")
          .filter("concept_synonym_name <> concept_name").select("concept_id", F.col("concept_synonym_name").alias("text_en")))
    labels = fr.join(en, "concept_id").withColumnRenamed("concept_id", "query_id")
    out = search.rank(labels, idx, groups={"en": "text_en", "fr": "text_fr", "fr_en": "text_fr"})
    return out.withColumn("score", F.round("score", 6))


@register("translate_labels")
def translate_labels(spark, sf_dir):
    """French labels translated word by word with the lexicon that the parallel labels
    give (a word's translations ranked by how often they stand in the other label),
    stored as English synonyms."""
    t = Tables(spark, sf_dir)
    syn = t.concept_synonym
    fr = syn.filter(F.col("language_concept_id") == LANG_FR).select("concept_id", F.col("concept_synonym_name").alias("fr"))
    en = syn.filter(F.col("language_concept_id") == LANG_EN).select("concept_id", F.col("concept_synonym_name").alias("en"))
    lex = lexicon.word_lexicon(fr.join(en, "concept_id"), "fr", "en")
    return lexicon.as_synonyms(lexicon.translate(fr, "concept_id", "fr", lex))
