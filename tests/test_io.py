"""Readers and writers on temporary folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from termspark.sources import readers, writers
from termspark.sources import store as store_module
from termspark.sources.store import Store


def test_store_versions(spark, tmp_path, monkeypatch):
    """Upserts are idempotent, write only the buckets of their keys, and appear as a whole."""
    path = str(tmp_path / "store")
    monkeypatch.setattr(store_module, "ROWS_PER_FILE", 5)
    store = Store(spark, path, "id")
    store.replace(spark.createDataFrame([(str(i), i) for i in range(50)], "id string, v long"))
    new = spark.createDataFrame([("3", 300), ("77", 77)], "id string, v long")
    folders = lambda: {r.bucket: r.folder for r in store.manifests().where(F.col("v") == store.version()).collect()}
    before = folders()
    store.upsert(new)
    assert 1 <= sum(before[b] != f for b, f in folders().items()) <= 2
    store.upsert(new)
    got = {r.id: r.v for r in store.read().collect()}
    assert len(got) == 51 and got["3"] == 300 and got["77"] == 77 and got["4"] == 4
    assert {r.id: r.v for r in store.read(0).collect()} == {str(i): i for i in range(50)}

    def fails(*_):
        raise RuntimeError("lost between write and publish")
    monkeypatch.setattr(Store, "_publish", fails)
    with pytest.raises(RuntimeError):
        store.upsert(spark.createDataFrame([("4", -1)], "id string, v long"))
    monkeypatch.undo()
    assert store.version() == 2 and {r.id: r.v for r in store.read().collect()} == got
    assert store.vacuum(keep=1) >= 1 and {r.id: r.v for r in store.read().collect()} == got


def test_store_buckets_follow_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "ROWS_PER_BUCKET", 10)
    store = Store(spark, str(tmp_path / "store"), "id")
    store.upsert(spark.range(200))
    assert store.manifests().agg(F.max("buckets")).first()[0] == 20 and store.read().count() == 200
    empty = Store(spark, str(tmp_path / "empty"), "id")
    with pytest.raises(Exception, match="no rows"):
        empty.read()


def test_store_writes_a_file_for_each_share_of_a_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "ROWS_PER_FILE", 100)
    rows = spark.range(3200).select(F.col("id").cast("string").alias("id"))
    store = Store(spark, str(tmp_path / "store"), "id")
    store.replace(rows)
    files = store.read().inputFiles()
    assert len(files) == store_module.MIN_BUCKETS * 4 and store.read().distinct().count() == 3200


def test_per_project_csv_and_plain_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "A"), (2, "B")], "concept_id long, m_project_type_id string")
    writers.write_per_project_csv(df, str(tmp_path / "exp"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "exp"))
    assert sorted((r.concept_id, r.m_project_type_id) for r in back.collect()) == [("1", "A"), ("2", "B")]
    assert (tmp_path / "exp" / "m_project_type_id=A").is_dir()
    writers.write_csv(df, str(tmp_path / "nohdr"))
    assert spark.read.csv(str(tmp_path / "nohdr")).count() == 2
    writers.write_text(df.select(F.col("m_project_type_id").alias("value")), str(tmp_path / "txt"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "txt")).collect()) == ["A", "B"]
    writers.write_orc(df, str(tmp_path / "orc"))
    assert spark.read.orc(str(tmp_path / "orc")).count() == 2
    writers.append_bulk(df, str(tmp_path / "app"), 2)
    writers.append_bulk(df, str(tmp_path / "app"), 2)
    assert spark.read.parquet(str(tmp_path / "app")).count() == 4
    assert writers.copy_table(spark, str(tmp_path / "app"), str(tmp_path / "copy")).count() == 4


def test_vocabulary_snapshot_and_small_readers(spark, tmp_path):
    src = tmp_path / "athena"
    src.mkdir()
    (src / "CONCEPT.csv").write_text(
        "concept_id|concept_name|domain_id|vocabulary_id|concept_class_id|standard_concept|concept_code|"
        "valid_start_date|valid_end_date|invalid_reason\n"
        '1|"Heart, attack"|Condition|SNOMED|Clinical Finding|S|22298006|20020131|20991231|\n')
    (src / "DOMAIN.csv").write_text("domain_id\tdomain_name\tdomain_concept_id\nCondition\tCondition\t19\n")
    base = readers.load_vocabulary(spark, str(src), str(tmp_path / "vocab"), "v1", tables=["concept", "domain"])
    c = spark.read.parquet(f"{base}/concept").first()
    assert c.concept_name == "Heart, attack" and c.valid_start_date == dt.date(2002, 1, 31)
    snap = spark.read.text(str(tmp_path / "vocab" / "CURRENT")).first().value
    assert snap == "v1"
    (tmp_path / "dic.tsv").write_text("g1\ta\ng1\tb\n")
    assert readers.read_tab_pairs(spark, str(tmp_path / "dic.tsv")).count() == 2
    (tmp_path / "codes.csv").write_text('cd,lib\nA01,"Cholera, unspecified"\n')
    assert readers.read_codes(spark, str(tmp_path / "codes.csv")).first().lib == "Cholera, unspecified"


def test_import_from_control(spark, tmp_path):
    root = tmp_path / "terms"
    (root / "north").mkdir(parents=True)
    (root / "north" / "a.csv").write_text("local_concept_name;local_concept_code;local_frequency\nx;1;2\nx;1;3\n;2;1\n")
    (root / "north" / "b.csv").write_text("something_else\nz\n")
    (tmp_path / "control.csv").write_text(
        "active,file,project,domain,vocabulary,language,mode,sep,quote\n"
        "1,a.csv,NORTH,Condition,LOCAL,FR,overwrite,;,\\\n"
        "1,b.csv,NORTH,Condition,LOCAL,FR,overwrite,;,\\\n"
        "0,c.csv,NORTH,Condition,LOCAL,FR,overwrite,;,\\\n")
    control = readers.read_control(spark, str(tmp_path / "control.csv"))
    good, rejects, report, skipped = readers.import_from_control(spark, control, str(root))
    assert good.count() == 1 and rejects.count() == 2
    assert skipped and skipped[0].endswith("b.csv")


def test_restrict_ids(spark):
    df = spark.range(10).withColumnRenamed("id", "concept_id")
    assert readers.restrict_ids(df, "concept_id", [1, 2]).count() == 2
    ids = spark.range(5).withColumnRenamed("id", "x")
    assert readers.restrict_ids(df, "concept_id", ids).count() == 5


def test_import_two_files_order_and_quarantine(spark, tmp_path):
    """Rows of two files keep their own statistics; malformed records are rejects."""
    from frames import tables
    from termspark.operators import changes
    root = tmp_path / "terms"
    for name, letter in (("north", "a"), ("south", "b")):
        (root / name).mkdir(parents=True)
        rows = "".join(f"{letter}{i},k{letter}{i},{100 * (letter == 'b') + i}\n" for i in range(20))
        extra = "broken,one,2,three,four\n" if letter == "a" else ""
        (root / name / "t.csv").write_text("local_concept_name,local_concept_code,local_frequency\n" + rows + extra)
    control = spark.createDataFrame([(1, "t.csv", p, "D", "L", "EN", "overwrite", ",", '"') for p in ("NORTH", "SOUTH")],
                                    "active int, file string, project string, domain string, vocabulary string, language string, mode string, sep string, quote string")
    good, rejects, report, _ = readers.import_from_control(spark, control, str(root))
    assert [(r.check, r.bad_rows) for r in report.collect()] == [("malformed", 1)]
    assert rejects.first().concept_name.startswith("broken")
    t = tables(spark, [], projects=[(1, "NORTH"), (2, "SOUTH")])
    concepts, stats = changes.insert_concepts(t, good, dt.date(2025, 1, 1))
    names = {r.concept_id: r.concept_name for r in concepts.collect()}
    values = {r.m_concept_id: r.m_value_as_number for r in stats.collect()}
    assert sorted(names) == list(range(min(names), min(names) + 40))
    for i, name in names.items():
        assert values[i] == 100 * (name[0] == "b") + int(name[1:])
    assert [names[i][0] for i in sorted(names)] == ["a"] * 20 + ["b"] * 20


def test_synonym_rule_lines(spark, tmp_path):
    """Equal lines are groups of their own; escapes, comments, groups of one, line ends of both kinds."""
    (tmp_path / "rules").mkdir()
    (tmp_path / "rules" / "a.txt").write_bytes(b"a, b, c # note\na, b, c\n# only a comment\n\nalone\nx\\, y, z\r\nq, qq => r, s\nk\\=>l, m\nn\\#1, o, o\n")
    groups, rewrites = readers.read_synonym_rules(spark, str(tmp_path / "rules"))
    by_line = {}
    for r in groups.collect():
        by_line.setdefault(r.group_key, []).append(r.member)
    assert sorted(map(sorted, by_line.values())) == [["a", "b", "c"], ["a", "b", "c"], ["k=>l", "m"], ["n#1", "o"], ["x, y", "z"]]
    assert sorted(map(tuple, rewrites.collect())) == [("q", "r"), ("q", "s"), ("qq", "r"), ("qq", "s")]
