"""Files written and read back, and the jobs end to end."""

import random
from pathlib import Path

import pytest

from mailweave import sources
from mailweave.operators import FEATURES, person_features
from mailweave.plans import cluster_people, ingest, rank_people, rank_quarters
from mailweave.session import shared_folder
from mailweave.sources import orders_mail
from mailweave.streaming import parse_new_files


def test_messages_keep_quotes_and_line_ends(spark, tmp_path):
    text = 'file,message\n"m/1","From: ""A"" <a@b.c>\nTo: x@y.z,\r\n\tq@r.s\n\n""hi"", \\ there"\n'
    (tmp_path / "dump.csv").write_bytes(text.encode() + b'm/2,short\nm/3\n"m/4",""\n')
    rows = sources.read_messages(spark, str(tmp_path / "dump.csv"), partitions=3).collect()
    assert {row.file: row.message for row in rows} == {
        "m/1": 'From: "A" <a@b.c>\nTo: x@y.z,\r\n\tq@r.s\n\n"hi", \\ there',
        "m/2": "short",
        "m/3": None,
        "m/4": None,
    }


def test_large_dump_is_split_inside_cells(spark, tmp_path):
    """Splits much smaller than a mail give the records of the plain reader."""
    rng = random.Random(11)
    pieces = ["a", '""', "\n", "\r\n", ",", "To: x@y.z", " ", "\n\n", "\\", "\u00e9"]
    for name, end in (("lf", "\n"), ("crlf", "\r\n")):
        rows = ["file,message"]
        for number in range(400):
            text = "".join(rng.choices(pieces, k=rng.choice([0, 3, 30, 300])))
            rows.append(f'"{name}/{number}","{text}"' if number % 7 else f"{name}/{number},plain")
        (tmp_path / f"{name}.csv").write_bytes((end.join(rows) + end).encode())
    expected = sources.read_messages(spark, str(tmp_path))
    sizes = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "1"}
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        found = sources.read_large_dump(spark, str(tmp_path))
        rows = found.collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    finally:
        for key in sizes:
            spark.conf.unset(key)
    assert len(rows) == 800
    # The plain reader turns CRLF inside the cells of a CRLF dump into LF.
    cells = sorted((row.file, row.message.replace("\r\n", "\n")) for row in rows if row.message)
    plain = [(row.file, row.message) for row in expected.collect() if row.message]
    assert cells == sorted((file, message.replace("\r\n", "\n")) for file, message in plain)
    assert any("\r\n" in row.message for row in rows if row.message)


EDGES = [
    ('"joe"@x.com', "a\\b@x.com", "to", "2001-05"),
    ("'q'@x.com", "b@x.com", "cc", "NA"),
    ("b@x.com", "b@x.com", "to", "2001-05"),
    ("b@x.com", "b@x.com", "to", "2001-05"),
]


@pytest.mark.parametrize("fmt", ["tsv", "parquet"])
def test_edges_come_back_unchanged(spark, tmp_path, fmt):
    edges = spark.createDataFrame(EDGES, "src string, dst string, type string, ym string")
    sources.write_edges(edges, str(tmp_path / "edges"), fmt)
    found = sources.read_edges(spark, str(tmp_path / "edges"), fmt)
    assert sorted(map(tuple, found.collect())) == sorted(EDGES)


def test_short_lines_are_left_out_and_counted(spark, tmp_path):
    (tmp_path / "edges.tsv").write_text("a\tb\tto\t2001-05\n a \t b\tcc\nc\td\njunk\n\n")
    path = str(tmp_path / "edges.tsv")
    counts = {}
    for fields in (2, 3, 4):
        kept = sources.read_edges(spark, path, "tsv", fields).collect()
        short = sources.count_short_lines(spark, path, "tsv", fields).first().short_lines
        counts[fields] = (len(kept), short)
        assert all((row.src, row.dst) in {("a", "b"), ("c", "d")} for row in kept)
    assert counts == {2: (3, 1), 3: (2, 2), 4: (1, 3)}


@pytest.mark.parametrize("fmt", ["tsv", "parquet"])
def test_features_come_back_unchanged(spark, parsed, tmp_path, fmt):
    features = person_features(parsed)
    sources.write_features(features, str(tmp_path / "features"), fmt)
    found = sources.read_features(spark, str(tmp_path / "features"), fmt)
    assert found.columns == ["email", *FEATURES]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, features.collect()))


def test_people_called_email_are_not_taken_for_a_header(spark, tmp_path):
    row = ("email.desk@x.com", 1, 1, 1, 0.5, 0.5, 1, 1.0)
    schema = "email string, " + ", ".join(f"{c} double" for c in FEATURES)
    df = spark.createDataFrame([row[:1] + tuple(map(float, row[1:]))], schema)
    sources.write_features(df, str(tmp_path / "features"), "parquet")
    assert spark.read.parquet(str(tmp_path / "features")).count() == 1


def test_persons_as_text(spark, tmp_path):
    persons = spark.createDataFrame([("a@b.c",), ("d@e.f",)], "email string")
    sources.write_persons(persons, str(tmp_path / "persons"), "text")
    lines = [p.read_text() for p in (tmp_path / "persons").glob("part-*")]
    assert sorted("".join(lines).split()) == ["a@b.c", "d@e.f"]


def test_jobs(spark, sf_dir, tmp_path):
    folder = str(tmp_path)
    metrics = ingest(spark, orders_mail.messages(spark, sf_dir), folder)
    assert {row.metric: row.value for row in metrics.collect()}["edges"] == 5648
    top = rank_people(spark, folder)
    assert top.first().email == "p7@en.example.com"
    rank_people(spark, folder, "log", iterations=2)
    series = rank_quarters(spark, folder, iterations=2)
    assert series.count() == 15 * 5
    # A tracked score is the score of the quarterly ranks.
    ranks = spark.read.parquet(f"{folder}/ranks/quarterly").withColumnRenamed("id", "email")
    joined = series.where("pagerank > 0").join(ranks, ["quarter", "email"])
    assert joined.where("pagerank <> rank").count() == 0
    assert joined.count() == series.where("pagerank > 0").count()
    assert len(list(Path(folder, "top", "quarterly").glob("part-*"))) == 1
    fits = cluster_people(spark, folder, ks=[3], iterations=3)
    assert fits[3].assignments.count() == 199
    profile = (Path(folder, "profiles", "k=3")).glob("part-*")
    assert next(profile).read_text().startswith("k\tcluster\tlabel\tpeople\trecvCount")


def test_incremental_ingest_equals_batch(spark, sf_dir, tmp_path, parsed):
    messages = orders_mail.messages(spark, sf_dir)
    dump, folder = str(tmp_path / "dump"), str(tmp_path / "out")
    halves = messages.randomSplit([0.5, 0.5], seed=3)
    for number, half in enumerate(halves):
        sources.write_messages(half, f"{dump}/{number}", "csv")
        parse_new_files(spark, f"{dump}/*", folder)
    found = spark.read.parquet(f"{folder}/parsed").select(parsed.columns)
    assert found.count() == parsed.count()
    assert found.exceptAll(parsed).count() == 0


class Unnamed:
    """A cluster session in which no checkpoint folder is set."""

    class sparkContext:  # noqa: N801
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

    conf = {}


def test_cluster_needs_a_named_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unnamed)


def test_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert spark.sparkContext.getCheckpointDir() is not None
    if named:
        assert folder == named


def test_large_dump_shuffles_the_ends_of_splits_alone(spark, tmp_path):
    mails = [(str(i), f'Subject: "{i}"\n\n' + "\n".join('x "y"' * (i % 7) for _ in range(i % 11))) for i in range(3000)]
    df = spark.createDataFrame(mails, sources.tables.MESSAGE_SCHEMA)
    sources.write_messages(df.coalesce(1), str(tmp_path / "dump"), "csv")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = sources.read_large_dump(spark, str(tmp_path / "dump"))
        assert {tuple(r) for r in found.collect()} == set(mails)
        assert found.count() == len(mails)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    # no window or grouping stands above all lines but that which counts quotes
    assert "monotonically" not in plan and plan.count("MapInArrow") == 2


def test_buckets_grow_with_the_edges(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sources.tables, "BUCKET_EDGES", 10)
    edges = spark.range(205).selectExpr("string(id) src", "'b' dst", "'to' type", "'NA' ym")
    assert sources.bucket_count(edges) == 21
    assert sources.bucket_count(edges.limit(3)) == 8
    sources.edges_table(edges, "growing_buckets", str(tmp_path / "t"), 21)
    try:
        files = list((tmp_path / "t").glob("part-*.parquet"))
        assert 10 < len(files) <= 21
        assert spark.table("growing_buckets").count() == 205
    finally:
        spark.sql("DROP TABLE growing_buckets")
