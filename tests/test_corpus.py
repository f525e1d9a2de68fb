"""Whole builds on small files."""

import json

import pytest

from corpusloom.operators.tokenizer import WordPiece, encode_pretraining
from corpusloom.plans.corpus import dataset_stats, prepare_dataset, write_raw
from corpusloom.plans import pretraining
from corpusloom.plans.settings import BuildSettings
from corpusloom.sources.manifest import read_manifest, route
from corpusloom.sources.registry import Location
from corpusloom.sources.sinks import read_parameters

LETTERS = "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="module")
def wp(spark):
    pieces = ["[PAD]", "[UNK]", "[SEP]", "[MASK]", *LETTERS, *[f"##{c}" for c in LETTERS]]
    return WordPiece(spark.createDataFrame(list(zip(pieces, range(len(pieces)))), "piece string, id int"))


def write_jsonl(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")
    return Location(str(path))


@pytest.mark.parametrize("strategy,cap", [("naive", None), ("naive", 5), ("sorted", None), ("not_packed", None)])
def test_pretraining_build(spark, wp, tmp_path, strategy, cap):
    docs = [{"doc_id": i, "text": LETTERS[: 1 + i % 26] * 3} for i in range(300)]
    places = {"c4": write_jsonl(tmp_path / "c4.jsonl", docs)}
    lens = "14,20" if strategy == "not_packed" else "8,32"
    settings = BuildSettings(
        max_seq_length=32, train_lengths=lens, dev_lengths="8,32", size_splits="0.25,0.75", dev_rows=40,
        strategy=strategy, max_train_rows=cap, group_rows=120,
    )
    prepare_dataset(spark, "c4", places, wp, settings, str(tmp_path / "out"))
    manifest = read_manifest(spark, str(tmp_path / "out" / "manifest"))
    sizes = {r.file: (r.seq_len, r["size"]) for r in manifest.collect()}
    rows = spark.read.parquet(str(tmp_path / "out" / "data")).collect()
    assert sum(s for _, s in sizes.values()) == len(rows)
    assert sizes["dev_1.jsonl"] == (32, 40) and sizes["train_0.jsonl"][0] == int(lens.split(",")[0])
    if strategy != "not_packed":
        assert all(len(r.input_ids) == r.seq_len for r in rows)
    if cap:
        assert sizes["train_1.jsonl"] == (32, cap)
    assert route(manifest).where("monitored").first().metric == "val/loss_32"
    assert {r.name: r.value for r in read_parameters(spark, str(tmp_path / "out" / "parameters")).collect()}["strategy"] == strategy


def test_single_length_build(spark, wp, tmp_path):
    places = {"c4": write_jsonl(tmp_path / "c4.jsonl", [{"doc_id": i, "text": "abcd " * 9} for i in range(50)])}
    for length in (16, 32):
        settings = BuildSettings(max_seq_length=32, train_lengths=str(length), dev_lengths="32", dev_rows=5)
        out = tmp_path / str(length)
        prepare_dataset(spark, "c4", places, wp, settings, str(out))
        sizes = {r.file: (r.seq_len, r["size"]) for r in read_manifest(spark, str(out / "manifest")).collect()}
        packed = 50 * (36 + 3) // 32 - 5
        assert sizes == {"train.jsonl": (length, packed * 32 // length), "dev.jsonl": (32, 5)}


def test_line_corpus(spark, wp, tmp_path):
    lines = [{"line_id": i, "text": "\n" if i % 5 == 4 else "abc\n"} for i in range(1000)]
    places = {"cc100": write_jsonl(tmp_path / "cc.jsonl", lines)}
    settings = BuildSettings(max_seq_length=16, dev_rows=3)
    assert dataset_stats(spark, "cc100", places, wp, settings).first().n == 200
    write_raw(spark, "cc100", places, settings, str(tmp_path / "raw"))
    assert spark.read.json(str(tmp_path / "raw" / "data")).count() == 1000
    prepare_dataset(spark, "cc100", places, wp, settings, str(tmp_path / "out"), fmt="json")
    assert spark.read.json(str(tmp_path / "out" / "data")).groupBy("role").count().count() == 2


def test_review_build_with_given_dev(spark, wp, tmp_path):
    row = "u\tabc\ttrue\tpositive\tx\n"
    (tmp_path / "t.tsv").write_text(row * 30)
    (tmp_path / "d.tsv").write_text(row * 12)
    places = {"germeval_B": Location(str(tmp_path / "t.tsv"), str(tmp_path / "d.tsv"), "csv")}
    for dev_rows, kept in ((-1, 12), (5, 5)):
        out = tmp_path / str(dev_rows)
        settings = BuildSettings(dev_rows=dev_rows, max_train_rows=20, truncate=False)
        prepare_dataset(spark, "germeval_B", places, wp, settings, str(out))
        counts = {r.role: r["count"] for r in spark.read.parquet(str(out / "data")).groupBy("role").count().collect()}
        assert counts == {"train": 20, "dev": kept}


def test_question_answering_build(spark, wp, tmp_path):
    rows = [
        {"id": i, "question": "abc?", "context": "abcde " * 60, "answers": {"text": ["abcde"], "answer_start": [6 * i]}}
        for i in range(20)
    ]
    places = {"germanquad": write_jsonl(tmp_path / "qa.jsonl", rows)}
    settings = BuildSettings(max_seq_length=128, dev_rows=4)
    prepare_dataset(spark, "germanquad", places, wp, settings, str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert got.where("role = 'dev'").count() == 4
    assert got.where("end_position > 0").select("id").distinct().count() == 20
    assert got.where("size(input_ids) > 128").count() == 0


def test_files_without_keys(spark, wp, tmp_path):
    texts = [f"abc {'lern ' * (i % 9)}ge" for i in range(60)]
    keyed = write_jsonl(tmp_path / "keyed.jsonl", [{"doc_id": i, "text": t} for i, t in enumerate(texts)])
    plain = write_jsonl(tmp_path / "plain.jsonl", [{"text": t, "url": "u"} for t in texts])
    settings = BuildSettings(max_seq_length=16, dev_rows=2)
    built = []
    for name, place in (("keyed", keyed), ("plain", plain)):
        out = tmp_path / name
        prepare_dataset(spark, "c4", {"c4": place}, wp, settings, str(out), fmt="json")
        built.append(sorted((r.role, tuple(r.input_ids)) for r in spark.read.json(str(out / "data")).collect()))
    assert built[0] == built[1] and len(built[0]) > 10
    mixed = write_jsonl(tmp_path / "mixed.jsonl", [{"doc_id": 1, "text": "abc"}, {"text": "abc"}])
    with pytest.raises(Exception, match="null order key"):
        prepare_dataset(spark, "c4", {"c4": mixed}, wp, BuildSettings(max_seq_length=16, dev_rows=0), str(tmp_path / "bad"))


def test_written_rows_are_in_order_at_the_manifests_paths(spark, wp, tmp_path):
    place = write_jsonl(tmp_path / "d.jsonl", [{"text": "abc " * (20 + i % 50)} for i in range(300)])
    prepare_dataset(spark, "c4", {"c4": place}, wp, BuildSettings(max_seq_length=16, dev_rows=5), str(tmp_path / "out"), fmt="json")
    files = read_manifest(spark, str(tmp_path / "out" / "manifest")).collect()
    assert {f.role for f in files} == {"train", "dev"}
    for f in files:
        rows = [json.loads(x) for p in sorted((tmp_path / "out" / "data" / f.path).glob("part-*")) for x in p.read_text().splitlines()]
        assert len(rows) == f.size
        assert [r["row_key"] for r in rows] == sorted(r["row_key"] for r in rows)


def test_leading_percent_of_a_build(spark, wp, tmp_path):
    rows = [{"line_id": i, "text": "\n" if i % 5 == 4 else "abc\n"} for i in range(1000)]
    places = {"cc100": write_jsonl(tmp_path / "cc.jsonl", rows)}
    settings = BuildSettings(max_seq_length=16, dev_rows=3, percent=35)
    write_raw(spark, "cc100", places, settings, str(tmp_path / "raw"))
    kept = sorted(r.line_id for r in spark.read.json(str(tmp_path / "raw" / "data")).collect())
    assert kept == list(range(350))
    stats = dataset_stats(spark, "cc100", places, wp, settings).first()
    assert (stats.role, stats.n) == ("train", 70)
    with pytest.raises(ValueError):
        BuildSettings(percent=0)


@pytest.mark.parametrize("strategy", ["naive", "sorted", "not_packed"])
def test_manifest_without_tokens(spark, wp, monkeypatch, strategy):
    """the manifest is that of the whole build, and no document is encoded for it."""
    docs = spark.createDataFrame([(i, LETTERS[: 1 + i % 26] * 3) for i in range(300)], "doc_id bigint, text string")
    settings = BuildSettings(max_seq_length=32, train_lengths="14,20", dev_lengths="8,32", dev_rows=40, strategy=strategy, group_rows=120)
    sizes = lambda rows: sorted(map(tuple, pretraining.pretraining_manifest(rows).collect()))
    whole = sizes(pretraining.build_pretraining(docs, wp, settings))
    monkeypatch.setattr(pretraining, "encode_pretraining", None)
    assert sizes(pretraining.build_pretraining(docs, wp, settings, tokens=False)) == whole


def test_whole_documents_encode_what_they_take(spark, wp, monkeypatch):
    """documents that are neither of a wanted length nor dev are counted alone; ids may repeat."""
    docs = [(i % 290, LETTERS[: 1 + i % 26]) for i in range(300)]
    seen = []

    def encode(rows, tokenizer):
        seen.append(rows.count())
        return encode_pretraining(rows, tokenizer)

    monkeypatch.setattr(pretraining, "encode_pretraining", encode)
    settings = BuildSettings(max_seq_length=32, train_lengths="14,20", dev_lengths="32", dev_rows=40, strategy="not_packed")
    rows = pretraining.build_pretraining(spark.createDataFrame(docs, "doc_id bigint, text string"), wp, settings).collect()
    ids = lambda text: [2, *[4 + LETTERS.index(text[0]), *[30 + LETTERS.index(c) for c in text[1:]]], 2]
    rest = sorted((k, ids(t)) for k, t in docs if len(t) + 2 not in (14, 20))
    assert sorted((r.row_key[0], r.input_ids) for r in rows if r.role == "train") == sorted((k, ids(t)) for k, t in docs if len(t) + 2 in (14, 20))
    assert sorted(t for r in rows if r.role == "dev" for t in r.input_ids) == sorted(t for _, x in rest[-40:] for t in x)
    assert seen and max(seen) < 60
