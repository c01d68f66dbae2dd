"""Readers: bulk table reads, strict CSV with quarantine, import control files,
tab dictionaries, code lists and vocabulary snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.plan_tools import cut_lineage
from ..operators import ingest

CORRUPT = "_corrupt_record"

# OMOP CDM vocabulary tables (public CDM v6 definition) as Spark DDL.
VOCABULARY_SCHEMAS = {
    "concept": "concept_id long, concept_name string, domain_id string, vocabulary_id string, "
               "concept_class_id string, standard_concept string, concept_code string, "
               "valid_start_date date, valid_end_date date, invalid_reason string",
    "vocabulary": "vocabulary_id string, vocabulary_name string, vocabulary_reference string, "
                  "vocabulary_version string, vocabulary_concept_id long",
    "domain": "domain_id string, domain_name string, domain_concept_id long",
    "concept_class": "concept_class_id string, concept_class_name string, concept_class_concept_id long",
    "concept_relationship": "concept_id_1 long, concept_id_2 long, relationship_id string, "
                            "valid_start_date date, valid_end_date date, invalid_reason string",
    "relationship": "relationship_id string, relationship_name string, is_hierarchical string, "
                    "defines_ancestry string, reverse_relationship_id string, relationship_concept_id long",
    "concept_synonym": "concept_id long, concept_synonym_name string, language_concept_id long",
    "concept_ancestor": "ancestor_concept_id long, descendant_concept_id long, "
                        "min_levels_of_separation int, max_levels_of_separation int",
    "drug_strength": "drug_concept_id long, ingredient_concept_id long, amount_value decimal(38,10), "
                     "amount_unit_concept_id long, numerator_value decimal(38,10), numerator_unit_concept_id long, "
                     "denominator_value decimal(38,10), denominator_unit_concept_id long, box_size int, "
                     "valid_start_date date, valid_end_date date, invalid_reason string",
}
# File delimiter and quote of each vocabulary file ('\b' = no quoting).
VOCABULARY_FORMATS = {name: ("\t", "\b") for name in VOCABULARY_SCHEMAS}
VOCABULARY_FORMATS["concept"] = ("|", '"')


# --------------------------------------------------------------- bulk reads
def read_table_bulk(spark: SparkSession, url: str, query: str, partition_column: str, lower: int, upper: int,
                    num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Parallel read of a database query, split on a numeric column."""
    return spark.read.jdbc(url, f"({query}) q", column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions, properties=properties or {})


def restrict_ids(df: DataFrame, column: str, ids) -> DataFrame:
    """Rows whose ``column`` is in ``ids``: a literal IN for a short Python list
    (pushed into the scan), a semi join for an id frame of any size."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select(F.col(ids.columns[0]).alias(column)), column, "left_semi")
    return df.filter(F.col(column).isin(list(ids)))


# ----------------------------------------------------------------- CSV
def read_csv_strict(spark: SparkSession, path: str, sep: str = ",", quote: str = '"', escape: str | None = None,
                    multiline: bool = False, strict: bool = False):
    """Header-driven all-string CSV.

    ``strict``: any malformed record fails the read (FAILFAST).  Otherwise the
    file is read PERMISSIVE with a quarantine column and (good, quarantine) is
    returned: malformed records are kept aside, not dropped.  ``multiline`` allows line
    breaks inside quotes, but then a file is read by one task, so it is asked for."""
    opts = {"header": "true", "sep": sep, "quote": quote, "multiLine": str(multiline).lower()}
    if escape is not None:
        opts["escape"] = escape
    if strict:
        return spark.read.options(mode="FAILFAST", **opts).csv(path)
    header = spark.read.options(**opts).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in header] + [StructField(CORRUPT, StringType())])
    df = (spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **opts)
          .schema(schema).csv(path))
    # parsed once into a staged table: the quarantine column cannot be queried
    # alone on a raw CSV, and both outputs (and the checks after) read it
    df = cut_lineage(df, "csv")
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    quarantine = df.filter(F.col(CORRUPT).isNotNull())
    return good, quarantine


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Import control file: active, file, project, domain, vocabulary, language, mode, sep, quote."""
    return spark.read.options(header="true", inferSchema="true").csv(path)


def import_from_control(spark: SparkSession, control: DataFrame, root: str):
    """Read every active term file named by the control rows (each with its own
    separator and quote, and line breaks in quotes where a column ``multiline`` is 1),
    stage it with its project, language, domain and vocabulary, and validate all of them
    in one plan.  Rows are ordered by file, then by row.  Malformed records become
    rejects with the reason ``malformed`` and the raw record as their name.  The control
    table is a handful of configuration rows, read on the driver; the term data never is.
    Returns (good, rejects, report, skipped files)."""
    staged, skipped, broken = [], [], []
    for number, row in enumerate(control.filter(F.col("active").cast("string") == "1").collect()):
        path = f"{root.rstrip('/')}/{str(row['project']).lower()}/{row['file']}"
        lines = "multiline" in control.columns and str(row["multiline"]) == "1"
        good, bad = read_csv_strict(spark, path, sep=str(row["sep"]), quote='"', escape=str(row["quote"]), multiline=lines)
        s = ingest.stage(good, str(row["project"]), str(row["language"]), str(row["domain"]),
                         str(row["vocabulary"]))
        if s is None:
            skipped.append(path)
        else:
            staged.append(s.withColumn("src_file", F.lit(path)).withColumn("src_file_no", F.lit(number)))
            broken.append(bad.select(F.col(CORRUPT).alias("concept_name"), F.lit(path).alias("src_file"),
                                     F.lit(number).alias("src_file_no"), F.lit("malformed").alias("reject_reason")))
    if not staged:
        return None, None, None, skipped
    allrows = staged[0]
    for s in staged[1:]:
        allrows = allrows.unionByName(s)
    good, rejects, _ = ingest.validate(allrows, unique=("src_file", "concept_code", "concept_name"))
    for bad in broken:
        rejects = rejects.unionByName(bad, allowMissingColumns=True)
    return good, rejects, ingest.report_of(rejects), skipped


def read_tab_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Headerless two-column tab file (_c0 group, _c1 variant)."""
    return spark.read.schema("_c0 string, _c1 string").options(sep="\t", header="false").csv(path)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    """Code list CSV with header (cd, lib), comma separated, double quotes."""
    return spark.read.options(header="true", sep=",", quote='"').csv(path)


def read_synonym_rules(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Synonym rule files -> (groups, rewrites).

    ``a, b, c`` is a group (group_key, member), ``x, y => z`` rewrites each left term
    (term, replacement); ``#`` starts a comment; blank lines and groups of one are skipped.
    A backslash takes the character behind it as it is (``\\,``, ``\\=>``, ``\\#``).  Each line
    is a group of its own, equal lines too: its key is the file and the line's place in it,
    so a file, which is a hand-kept dictionary, is read by one task."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    lines = files.select("file", F.posexplode(F.split("value", "\r?\n")).alias("nr", "line"))
    lines = lines.select(F.concat_ws(":", "file", "nr").alias("group_key"),
                         F.trim(F.regexp_replace("line", r"(?<!\\)#.*$", "")).alias("line")).filter("line <> ''")
    plain = lambda x: F.trim(F.regexp_replace(x, r"\\(.)", "$1"))
    terms = lambda c: F.filter(F.transform(F.split(c, r"(?<!\\),"), plain), lambda x: x != "")
    sides = lines.withColumn("s", F.split("line", r"(?<!\\)=>", 2))
    groups = (sides.filter(F.size("s") == 1).select("group_key", F.array_distinct(terms(F.col("line"))).alias("m"))
              .filter(F.size("m") > 1).select("group_key", F.explode("m").alias("member")))
    rewrites = (sides.filter(F.size("s") == 2).select(F.explode(terms(F.get("s", 0))).alias("term"), terms(F.get("s", 1)).alias("r"))
                .select("term", F.explode("r").alias("replacement")).distinct())
    return groups, rewrites


# ----------------------------------------------------- vocabulary snapshot
def read_vocabulary_file(spark: SparkSession, path: str, table: str) -> DataFrame:
    sep, quote = VOCABULARY_FORMATS[table]
    return (spark.read.schema(VOCABULARY_SCHEMAS[table])
            .options(header="true", sep=sep, quote=quote, dateFormat="yyyyMMdd", mode="FAILFAST")
            .csv(path))


def load_vocabulary(spark: SparkSession, src_dir: str, out_dir: str, snapshot: str,
                    tables: Iterable[str] = tuple(VOCABULARY_SCHEMAS), file_names: dict | None = None) -> str:
    """Typed load of a vocabulary release into ``out_dir/snapshot/<table>`` (Parquet,
    overwrite); once every table is written the snapshot id is published in
    ``out_dir/CURRENT``, so readers never see a half-loaded release."""
    names = file_names or {t: f"{t.upper()}.csv" for t in tables}
    base = f"{out_dir.rstrip('/')}/{snapshot}"
    for t in tables:
        read_vocabulary_file(spark, f"{src_dir.rstrip('/')}/{names[t]}", t).write.mode("overwrite").parquet(f"{base}/{t}")
    spark.createDataFrame([(snapshot,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{out_dir.rstrip('/')}/CURRENT")
    return base


def current_vocabulary(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    snap = spark.read.text(f"{out_dir.rstrip('/')}/CURRENT").first()["value"]
    base = f"{out_dir.rstrip('/')}/{snap}"
    return {t: spark.read.parquet(f"{base}/{t}") for t in VOCABULARY_SCHEMAS}
