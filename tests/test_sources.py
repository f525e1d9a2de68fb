import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import RULE_LINE
from corpusloom.operators.ordering import Order
from corpusloom.plans.settings import BuildSettings
from corpusloom.session import materialize, scratch_path, scratch_root
from corpusloom.sources import readers
from corpusloom.sources.manifest import build_manifest, read_manifest, route, write_manifest
from corpusloom.sources.registry import Location, load_dataset, task_of
from corpusloom.sources.sinks import append_results, read_parameters, read_results, with_role, write_parameters, write_splits


def test_books_and_articles(spark, tmp_path):
    (tmp_path / "books" / "deep").mkdir(parents=True)
    (tmp_path / "books" / "a.txt").write_text(f"one{RULE_LINE}two", encoding="utf-8")
    (tmp_path / "books" / "deep" / "btxt").write_text("three\nlines\n", encoding="utf-8")
    (tmp_path / "books" / "c.md").write_text("no", encoding="utf-8")
    books = readers.read_text_files(spark, str(tmp_path / "books"))
    assert sorted(r.text for r in books.collect()) == ["onetwo", "three\nlines\n"]
    merged = readers.merge_books_and_articles(books, spark.createDataFrame([("art",)], "text string"))
    assert sorted((r.part, r.text) for r in merged.collect()) == [(0, "onetwo"), (0, "three\nlines\n"), (1, "art")]
    assert readers.merge_books_and_articles(books, None).count() == 2


def test_reviews(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("u1\tgood\ttrue\tpositive\tx\nu2\t\tfalse\tneutral\tx\nu3\tmeh\tfalse\tneutral\tx\n")
    place = {"germeval_A": Location(str(tmp_path / "t.tsv"), format="csv"), "germeval_B": Location(str(tmp_path / "t.tsv"), str(tmp_path / "t.tsv"), "csv")}
    train, dev = load_dataset(spark, "germeval_A", place)
    assert sorted((r.text, r.label) for r in train.collect()) == [("good", 1), ("meh", 0)] and dev is None
    train, dev = load_dataset(spark, "germeval_B", place)
    assert sorted((r.text, r.label) for r in dev.collect()) == [("good", 2), ("meh", 1)]


def test_annotated_and_missing(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"doc_id": 1, "text": "t", "annotations": [{"user": "a", "label": "3-Stark"}]}\n')
    train, _ = load_dataset(spark, "germeval_24", {"germeval_24": Location(str(tmp_path / "a.jsonl"))})
    assert train.first().label == 3
    with pytest.raises(FileNotFoundError):
        load_dataset(spark, "c4", {"c4": Location(str(tmp_path / "none.jsonl"))})
    with pytest.raises(ValueError):
        load_dataset(spark, "c4", {})
    with pytest.raises(ValueError):
        task_of("nothing")


def test_field_types_merge(spark):
    lines = ['{"a": 1, "b": null, "c": {"x": 1}}', '{"a": 2, "b": "t", "c": {"y": [true]}}', '{"a": "s"}', "no json", "[1]", "", '{}']
    got = {r.field: (r.n_rows, r.type) for r in readers.field_types(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {
        "a": (3, "VARIANT"), "b": (2, "STRING"), "c": (2, "OBJECT<x: BIGINT, y: ARRAY<BOOLEAN>>"), None: (2, "INVALID")
    }
    assert readers.field_types(spark.createDataFrame([], "value string")).count() == 0


def test_files_that_do_not_fit_are_refused(spark, tmp_path):
    def load(name, *lines):
        (tmp_path / name).write_text("\n".join(lines))
        return load_dataset(spark, "c4", {"c4": Location(str(tmp_path / name))})[0]

    with pytest.raises(ValueError, match="no usable field text.*content STRING \\(2 rows\\)"):
        load("other.jsonl", '{"content": "one"}', '{"content": "two"}')
    with pytest.raises(ValueError, match="INVALID"):
        load("broken.jsonl", "not json", "at all")
    assert load("nulls.jsonl", '{"text": null}').count() == 1
    assert load("empty.jsonl", "").count() == 0
    assert load("some.jsonl", '{"doc_id": 1, "text": "t"}', '{"doc_id": 2}').count() == 2


def test_leading_percent_rounds_half_to_even(spark):
    for n, percent, keep in ((5, 50, 2), (7, 50, 4), (10, 33, 3)):
        rows = spark.range(n)
        assert readers.leading_percent(rows, percent, Order.of_id("id"), ["id"]).count() == keep


def test_splits_and_manifest(spark, tmp_path):
    rows = spark.range(10).withColumn("seq_len", F.lit(64))
    tagged = with_role(rows.where("id < 7"), rows.where("id >= 7"))
    write_splits(tagged, str(tmp_path / "s"), "json")
    assert spark.read.json(str(tmp_path / "s")).groupBy("role").count().count() == 2
    manifest = build_manifest(tagged)
    write_manifest(manifest, str(tmp_path / "m"))
    assert {(r.file, r.size) for r in read_manifest(spark, str(tmp_path / "m")).collect()} == {("train.jsonl", 7), ("dev.jsonl", 3)}
    with pytest.raises(ValueError):
        with_role(None, None)


def test_routing_by_name(spark):
    files = spark.createDataFrame(
        [("dev_0.jsonl", "", 64), ("dev_1.jsonl", "", 128), ("train_0.jsonl", "", 64), ("train_2.jsonl", "", 1), ("train_10.jsonl", "", 128), ("x", "", 1)],
        "file string, role string, seq_len int",
    )
    got = {r.file: (r.role, r.position, r.metric, r.monitored) for r in route(files).collect()}
    assert got["dev_0.jsonl"] == ("dev", 0, "val/loss_64", False)
    assert got["dev_1.jsonl"] == ("dev", 1, "val/loss_128", True)
    assert got["train_10.jsonl"][1] < got["train_2.jsonl"][1] and len(got) == 5


def test_records(spark, tmp_path):
    for value in (1.5, 2.5):
        append_results(spark.createDataFrame([("run", value)], "run_name string, result double"), str(tmp_path / "r"))
    assert sorted(r.result for r in read_results(spark, str(tmp_path / "r")).collect()) == [1.5, 2.5]
    write_parameters(spark, {"a": 1, "b": None}, str(tmp_path / "p"))
    assert {(r.name, r.value) for r in read_parameters(spark, str(tmp_path / "p")).collect()} == {("a", "1"), ("b", None)}


def test_settings():
    s = BuildSettings(train_lengths="64,128")
    assert s.training == [64, 128] and s.splits == [0.5, 0.5] and s.validation == [512]
    for bad in (dict(strategy="x"), dict(train_lengths="1,2", size_splits="0.5"), dict(train_lengths="1,2", size_splits="0.5,0.4")):
        with pytest.raises(ValueError):
            BuildSettings(**bad)


class StubSession:
    """The few parts of a session that the scratch folder depends on."""

    def __init__(self, setting, master):
        self.conf, self.sparkContext, self.master, self.folder = self, self, master, None
        self.setting = setting

    def get(self, key, default):
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_follows_the_session(spark):
    assert scratch_path(StubSession("/shared", "spark://x"), "t").startswith("/shared/t-")
    with pytest.raises(RuntimeError):
        scratch_root(StubSession(None, "spark://x"))
    local = StubSession(None, "local[2]")
    assert scratch_root(local) == scratch_root(local) == local.folder
    assert scratch_path(spark, "x").startswith(scratch_root(spark))
    assert materialize(spark.range(3), "x").count() == 3


def test_rows_are_numbered_without_being_written(spark, tmp_path):
    """Several files and splits, some of them in one task; what is filtered afterwards keeps its number."""
    path, n = str(tmp_path / "rows"), 30_000
    spark.range(n).select(F.format_string("%06d", "id").alias("text")).repartitionByRange(3, "text").sortWithinPartitions("text").write.json(path)
    settings = {"spark.sql.files.maxPartitionBytes": "150000", "spark.sql.files.openCostInBytes": "1000"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = readers.with_row_ids(spark.read.schema("text string").json(path))
        assert rows.rdd.getNumPartitions() > 3
        assert "numbered-" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.where("doc_id = cast(text as bigint)").count() == n
        assert {r.doc_id for r in rows.where("text >= '029990'").collect()} == set(range(29_990, n))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
