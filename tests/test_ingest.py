"""Import chain: CSV read with quarantine, checks, dedup, rejects."""

from termspark.operators import ingest
from termspark.sources import readers


def test_csv_quarantine_and_strict(spark, tmp_path):
    p = tmp_path / "terms.csv"
    p.write_text('local_concept_name;local_concept_code;local_frequency\n"a";"c1";"3"\n"b";"c2"\n"x";"c3";"4";"extra"\n')
    good, bad = readers.read_csv_strict(spark, str(p), sep=";")
    assert good.count() + bad.count() == 3
    assert bad.count() >= 1
    import pytest
    with pytest.raises(Exception):
        readers.read_csv_strict(spark, str(p), sep=";", strict=True).collect()


def test_validate_semantics(spark):
    rows = [("n1", "c1", "5", 1), (None, "c2", "1", 2), ("n3", "c3", "bad", 3),
            ("n1", "c1", "7", 4), ("n4", None, None, 5), ("n4", None, "2", 6)]
    df = spark.createDataFrame(rows, "local_concept_name string, local_concept_code string, "
                                     "local_frequency string, src_order long")
    good, rejects, report = ingest.import_terms(df, "NORTH", "FR", "Condition", "LOCAL")
    g = {r.src_order: r for r in good.collect()}
    assert sorted(g) == [1, 5]  # dup (c1, n1) keeps lowest order; null codes are equal keys
    assert g[1].m_value_as_number == 5.0 and g[5].m_value_as_number is None
    rj = {r.src_order: r.reject_reason for r in rejects.collect()}
    assert rj == {2: "null:concept_name", 3: "not_numeric:m_value_as_number", 4: "duplicate", 6: "duplicate"}
    assert {r.check: r.bad_rows for r in report.collect()} == {
        "null:concept_name": 1, "not_numeric:m_value_as_number": 1, "duplicate": 2}


def test_required_column_missing_skips(spark):
    df = spark.createDataFrame([("x",)], "other string")
    assert ingest.missing_columns(df.columns, ingest.REQUIRED_COLUMNS) == ["local_concept_name"]
    assert ingest.import_terms(df, "P", "FR", "D", "V") is None


def test_backfill_optional_columns(spark):
    df = ingest.backfill(spark.createDataFrame([("x",)], "local_concept_name string"))
    assert set(df.columns) == {"local_concept_name", "local_concept_code", "local_frequency"}
