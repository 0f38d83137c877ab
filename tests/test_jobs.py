"""Sources, sinks, releases and streams on files."""

import hashlib
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from widelathe.operators import combine, dedup, enrich, reports
from widelathe.plans import release
from widelathe.sources import csv, sinks
from widelathe.streaming import ingest


def test_tolerant_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n\n2\n3,z\n4,p,q,r\n5,"say ""hi"", twice"\n6,\n', encoding="utf-8")
    rows = csv.read_tolerant(spark, str(tmp_path), ["a", "b"])
    assert {r["a"]: r["b"] for r in rows.collect()} == {"1": "x\ny", "2": None, "3": "z", "5": 'say "hi", twice', "6": None}
    assert rows.count() == 5


def test_a_stray_quote_harms_no_other_row(spark, tmp_path):
    lines = [f'{k},"open name,{k}' if k == 5 else f"{k},name {k},{k}" for k in range(1000)]
    (tmp_path / "a.csv").write_text("k,n,v\n" + "\n".join(lines), "utf-8")
    (tmp_path / "b.csv").write_text("k,n,v\n" + "\n".join(f"{k},name {k},{k}" for k in range(1000, 3000)) + '\n3000,"last,1', "utf-8")
    rows = csv.read_tolerant(spark, str(tmp_path), ["k", "n", "v"])
    got = {int(r["k"]): (r["n"], r["v"]) for r in rows.collect()}
    assert rows.count() == len(got) == 3001 and got[5] == ("open name", "5") and got[3000] == ("last", "1")
    assert all(v == (f"name {k}", str(k)) for k, v in got.items() if k not in (5, 3000))


def by_line(text, glued):
    """The records of a file, one line after the other."""
    out, held = [], []
    for line in text.split("\n"):
        held.append(line)
        whole = "\n".join(held)
        if whole.count('"') % 2 == 0:
            out.append(whole)
        elif len(held) >= glued:
            out += [v.replace('"', "") for v in held]
        else:
            continue
        held = []
    return (out + [v.replace('"', "") for v in held])[1:]


@pytest.mark.parametrize(("broadcast", "size", "glued"), [(100_000, 64, 10), (100_000, 23, 3), (0, 64, 10), (100_000, 400, 1)])
def test_records_of_split_files(spark, tmp_path, monkeypatch, broadcast, size, glued):
    monkeypatch.setattr(csv, "BROADCAST_FILES", broadcast)
    rng = random.Random(size)
    texts = ["h,1", 'h"ead', '"a\n\nb",c\n"d']
    for share in (0.02, 0.1, 0.4, 0.8):
        for n in (1, 7, 60):
            texts.append("\n".join("".join(rng.choice("ab,") for _ in range(rng.randrange(9))) + ('"' if rng.random() < share else '""' if rng.random() < 0.1 else "") for _ in range(n)))
    texts = [t + "\n" * (k % 2) for k, t in enumerate(texts)]
    for k, t in enumerate(texts):
        (tmp_path / f"{k}.csv").write_text(t, "utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    spark.conf.set("spark.sql.files.minPartitionNum", 1)
    try:
        got = sorted(r[0] for r in csv.records(spark, str(tmp_path), glued).collect())
        wanted = sorted(r for t in texts for r in by_line(t.removesuffix("\n"), glued))
    finally:
        for c in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{c}")
    assert got == wanted


def test_a_file_with_a_stray_quote_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(f'{k},"open,{k}' if k == 700 else f"{k},name {k},{k}" for k in range(1600)), "utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", -(-(tmp_path / "a.csv").stat().st_size // 8))
    try:
        rows = csv.records(spark, str(tmp_path / "a.csv"))
        parts = rows.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(parts) == 8 and sum(r["count"] for r in parts) == 1599


def test_flexible_csv_reads_without_quotes_what_does_not_balance(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k;n\n1;"open\n2;b\n', "utf-8")
    (tmp_path / "b.csv").write_text('k;n\n3;"two\nlines"\n', "utf-8")
    read = csv.read_flexible(spark, [str(tmp_path)], order="src_ord")
    assert {r["K"]: r["N"] for r in read.collect()} == {"1": '"open', "2": "b", "3": "two\nlines"}
    assert [r["K"] for r in read.where("K < 3").orderBy("src_ord").collect()] == ["1", "2"]


def test_flexible_csv_tells_an_even_number_of_stray_quotes_from_lines_that_go_on(spark, tmp_path):
    (tmp_path / "stray.csv").write_text('k;n\n1;"open\n2;b\n3;"more;x\n', "utf-8")
    (tmp_path / "both.csv").write_text('k;n\n4;"two\nlines"\n5;"open\n6;b\n7;"more\n', "utf-8")
    (tmp_path / "whole.csv").write_text('k;n\n10;"""two"" \nlines;"\n11;"a;b"\n12;6" x\n13;8" y\n', "utf-8")
    found = {f.rsplit("/", 1)[1]: quoting for (_, _, quoting, _), files in csv.dialects(spark, [str(tmp_path)]).items() for f in files}
    assert found == {"stray.csv": "off", "both.csv": "off", "whole.csv": "lines"}
    got = {r["K"]: r["N"] for r in csv.read_flexible(spark, [str(tmp_path)]).collect()}
    assert {k: got[k] for k in ("1", "2", "3", "5", "6", "7")} == {"1": '"open', "2": "b", "3": '"more', "5": '"open', "6": "b", "7": '"more'}
    assert {k: got[k] for k in ("10", "11", "12", "13")} == {"10": '"two" \nlines;', "11": "a;b", "12": '6" x', "13": '8" y'}


@pytest.mark.parametrize("few", [100_000, 1])
def test_the_order_of_files_is_data(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(dedup, "BROADCAST_FILES", few)
    for name, first in (("b", 100), ("a", 0), ("c", 200)):
        (tmp_path / f"{name}.csv").write_text("entity_id;endpoint_key;value\n" + "\n".join(f"RM{k:08d};e;{k}" for k in range(first, first + 50)), "utf-8")
    rows = csv.normalize_long(spark.read.options(header=True, sep=";").csv(str(tmp_path)))
    assert [r["value_num"] for r in rows.repartition(7).orderBy("src_ord").collect()] == [*range(50), *range(100, 150), *range(200, 250)]
    with pytest.raises(ValueError, match="order"):
        csv.normalize_long(spark.createDataFrame([("a", "b", "1")], "entity_id string, endpoint_key string, value string"))
    plan = rows.groupBy("entity_id").agg(F.min_by("value_num", "src_ord"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_reports_lack_no_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text("CODICE_SCUOLA,VALORE\nRM1,2\n", "utf-8")
    with pytest.raises(ValueError, match="DESCRITTORE, COLONNA"):
        csv.read_clean_reports(spark, str(tmp_path), ["CODICE_SCUOLA", "VALORE"])


def test_bad_reports_leave_nothing_written(spark, tmp_path):
    bad = spark.createDataFrame([("RM1", "2.2.a.1", "no parts", "Punteggio medio", "1", 1)], "entity_id string, descriptor string, heading string, column_label string, value string, src_ord int")
    with pytest.raises(reports.BadRows):
        sinks.write_clean(bad, f"{tmp_path}/out")
    assert not (tmp_path / "out").exists()


def test_flexible_csv_looks_at_whole_files(spark, tmp_path):
    names = [f"A_LONG_COLUMN_NAME_THAT_FILLS_THE_LINE_{k}" for k in range(150)]
    row = ";".join(str(k) for k in range(150))
    (tmp_path / "wide.csv").write_text(";".join(names) + f"\n{row}\n", "utf-8")
    (tmp_path / "late.csv").write_bytes(("CODICE;NOME\n" + "x;plain\n" * 1000 + "y;Forlì’\n").encode("cp1252"))
    read = csv.read_flexible(spark, [str(tmp_path)])
    assert set(read.columns) == {*names, "CODICE", "NOME"}
    assert read.where("CODICE = 'y'").select("NOME").collect() == [("Forlì’",)]
    assert read.where(f"{names[0]} = '0'").select(names[149]).collect() == [("149",)]


def test_flexible_csv_finds_delimiter_encoding_and_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿codice;nome\n1;Forlì\n".encode())
    (tmp_path / "b.csv").write_bytes("Codice\tNome\n2\tCantù – “x”\n".encode("cp1252"))
    got = sorted(map(tuple, csv.read_flexible(spark, [str(tmp_path)]).select("CODICE", "NOME").collect()))
    assert got == [("1", "Forlì"), ("2", "Cantù – “x”")]
    with pytest.raises(ValueError, match="no files"):
        (tmp_path / "empty").mkdir()
        csv.read_flexible(spark, [str(tmp_path / "empty")])


def test_delimiters():
    assert csv.detect_delimiter("a;b;c\n1,2;3,4,5,6") == ";" and csv.detect_delimiter("a") == ","
    assert csv.detect_delimiter("a;b\n1,2,3", by_count=True) == ","


def test_area_is_that_of_the_nearest_folder(spark):
    paths = [("file:/x/SUD/nord_est/a.csv",), ("/x/Isole/sub/SUD.csv",), ("/x/y.csv",)]
    got = [r[0] for r in spark.createDataFrame(paths, "p string").select(csv.area_of(F.col("p"))).collect()]
    assert got == ["NORD_EST", "ISOLE", None]


def test_catalogue_repair(spark):
    lines = [('"1,""Scuola Ã¨, x"",http://u"',), ('2,plain €,http://v',)]
    got = [tuple(r) for r in csv.repair_catalogue(spark.createDataFrame(lines, "value string"), ["c", "n", "u"]).collect()]
    assert got == [("1", "Scuola è, x", "http://u"), ("2", "plain €", "http://v")]


def test_package_replaces_itself_and_tells_its_rows(spark, tmp_path):
    wide = spark.createDataFrame([("a", "line\nbreak", 1.5), ("b", None, None)], "entity_id string, note string, v double")
    path = f"{tmp_path}/p"
    for _ in range(2):
        release.write_package(wide, path, unmatched=wide.select("entity_id").limit(1), package="ALL")
    facts = json.loads(spark.read.text(f"{path}/manifest").first()[0])
    assert (facts["rows"], facts["columns"], facts["unmatched"], facts["package"]) == (2, 3, 1, "ALL")
    back = {r["entity_id"]: r["note"] for r in spark.read.option("header", True).csv(f"{path}/wide.csv").collect()}
    assert back == {"a": "line break", "b": None}
    assert sinks.snapshot(spark, f"{path}/wide.parquet").where("length(sha256) = 64").count() > 0


LONG = "entity_id string, entity_name string, endpoint_key string, category string, level string, value_num double, src_ord int, src_file string"


@pytest.mark.parametrize("observed", [64, 0])
def test_release_by_the_files_areas(spark, tmp_path, monkeypatch, observed):
    monkeypatch.setattr(release, "OBSERVED_AREAS", observed)
    ep = "entrate_fonti_finanziamento"
    rows = [("A", "a", ep, "cat one", "scuola", 1.0, 1, "/x/SUD/a.csv"), ("A", "a", ep, "other", "", 2.0, 2, "/x/SUD/a.csv"), ("A", "a", ep, "cat one", "", 9.0, 3, "/x/ISOLE/b.csv"), ("B", "b", ep, "c" * 47 + "12", "", 4.0, 4, "/x/ISOLE/b.csv"), ("B", "b", ep, "c" * 47 + "13", "", 5.0, 5, "/x/ISOLE/b.csv"), ("C", None, "abbandoni_24_25", "y6", "", 7.0, 6, "/x/none.csv")]
    obs = spark.createDataFrame(rows, LONG)
    for _ in range(2):
        got = release.release(obs, str(tmp_path), "v1", inputs=("/x",))
        assert sorted(map(tuple, got.collect())) == [("ALL", 3), ("areas/ISOLE", 2), ("areas/SUD", 1)]
    everything = {r["entity_id"]: r.asDict() for r in release.read_package(spark, str(tmp_path), "v1").collect()}
    assert (everything["A"]["20_entrate_cat_one_pct"], "20_entrate_other_pct" in everything["A"], everything["C"]["10_abbandoni_y6"]) == (1.0, False, 7.0)
    assert not any("c" * 40 in c for c in everything["B"])  # ALL has rows in scope, these aren't
    isles = {r["entity_id"]: r.asDict() for r in release.read_package(spark, str(tmp_path), "v1", "ISOLE").collect()}
    assert (isles["A"]["20_entrate_cat_one_pct"], isles["B"]["20_entrate_" + "c" * 47 + "12_pct"], isles["B"]["20_entrate_" + "c" * 47 + "13_pct"]) == (9.0, 4.0, 5.0)
    south = release.read_package(spark, str(tmp_path), "v1", "SUD")
    assert "10_abbandoni_y6" not in south.columns and south.first()["20_entrate_cat_one_pct"] == 1.0
    facts = {r["package"]: (r["long_rows"], r["files"], r["unmatched"]) for r in release.read_manifests(spark, str(tmp_path), "v1", "package string, long_rows long, files long, unmatched long").collect()}
    assert facts == {"ALL": (6, 3, 0), "areas/ISOLE": (3, 1, 0), "areas/SUD": (2, 1, 0)}
    assert release.release(obs, str(tmp_path), "v2", area=None).count() == 1


def test_a_release_out_of_files(spark, tmp_path):
    for area, k in (("SUD", 1), ("NORD_EST", 2)):
        (tmp_path / "in" / area).mkdir(parents=True)
        (tmp_path / "in" / area / "o.csv").write_text(f"CODICE_SCUOLA;endpoint;category;value\nRM0000000{k};abbandoni_24_25;y{k};{k},5\n", "utf-8")
    obs = csv.normalize_long(csv.read_flexible(spark, [f"{tmp_path}/in"], order="src_ord", file="src_file"))
    packages = release.release(obs, f"{tmp_path}/out", "v1")
    assert sorted(map(tuple, packages.collect())) == [("ALL", 2), ("areas/NORD_EST", 1), ("areas/SUD", 1)]
    north = release.read_package(spark, f"{tmp_path}/out", "v1", "NORD_EST").first().asDict()
    assert north["10_abbandoni_y2"] == 2.5 and "10_abbandoni_y1" not in north


def test_signature_ignores_order_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, v string")
    sign = lambda d: combine.signature(d, ["k", "v"]).first()[0]
    assert sign(df) == sign(df.orderBy(F.desc("k")).repartition(3)) != sign(df.distinct())


def test_files_are_taken_once(spark, tmp_path):
    source, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    schema = spark.createDataFrame([], "k int, v int").schema
    for k in range(3):
        spark.createDataFrame([(k, 1), (0, 2)], schema).write.mode("append").parquet(source)
        ingest.ingest(spark, source, schema, out, checkpoint, lambda b: b.withColumn("src_ord", F.col("v")))
        ingest.ingest(spark, source, schema, out, checkpoint, lambda b: b.withColumn("src_ord", F.col("v")))
    taken = spark.read.parquet(out)
    assert taken.count() == 6
    assert sorted(map(tuple, ingest.first_delivery(taken, ["k"]).select("k", "v").collect())) == [(0, 1), (1, 1), (2, 1)]


def test_windowed_activity(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 10:00:00", "a", 1.0), ("2024-01-01 11:00:00", "a", 2.0), ("2024-01-05 00:00:00", "b", 3.0)], "t string, k string, value double").withColumn("t", F.to_timestamp("t"))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = ingest.windowed_activity(stream, "t", ["k"]).writeStream.format("memory").queryName("activity").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r["k"], r["n"], r["value"]) for r in spark.sql("SELECT * FROM activity").collect()) == [("a", 2, 3.0), ("b", 1, 3.0)]


def test_no_code_too_large_to_compile(spark, tmp_path):
    from widelathe.plans.queries_io import _report_rows

    good, _ = reports.clean_reports(_report_rows(spark, "/root/testdata/sf0.001"), on_bad="quarantine")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert reports.report_wide(good).count() > 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_cleaning_reads_once_and_counts(spark, tmp_path):
    columns = "entity_id string, descriptor string, heading string, column_label string, value string, src_ord int"
    rows = [("RM1", "2.2.a.1", "a - b | c", "Punteggio medio", "1", 1), ("RM1", "1.1.b.1", "x", "x", "1", 2), ("RM2", "2.2.a.1", "no parts", "Punteggio medio", "1", 3)]
    df = spark.createDataFrame(rows, columns)
    counts = sinks.write_clean(df, f"{tmp_path}/out", "quarantine", f"{tmp_path}/bad")
    assert counts == {"clean": 1, "bad": 1, "dropped_descriptor": 1, "dropped_label": 0, "dropped_measure": 0}
    before = sorted(p.name for p in tmp_path.iterdir())
    assert before == ["bad", "out"]
    with pytest.raises(reports.BadRows) as e:
        sinks.write_clean(df, f"{tmp_path}/out", "fail")
    assert len(e.value.examples) == 1 and sorted(p.name for p in tmp_path.iterdir()) == before  # what stood there stays
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").count() == 1


def test_digests_by_ranges(spark, tmp_path):
    for k, size in enumerate((1, 1000, 5000)):
        (tmp_path / f"{k}.bin").write_bytes(bytes(range(256)) * size)
    got = sinks.snapshot(spark, str(tmp_path), range_bytes=777)
    assert "content" not in got.columns
    assert {r["name"]: r["sha256"] for r in got.collect()} == {f"{k}.bin": hashlib.sha256(bytes(range(256)) * n).hexdigest() for k, n in enumerate((1, 1000, 5000))}


def test_repeats_are_known_to_the_stream(spark, tmp_path):
    source, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    schema = "k int, v int, ts timestamp, src_ord int"
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    for rows in ([(1, 1, day(0), 1), (1, 1, day(0), 1), (2, 1, day(1), 2)], [(1, 9, day(0), 1), (3, 1, day(60), 3)], [(4, 1, day(61), 4)], [(1, 7, day(62), 1)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        ingest.ingest_once(spark, source, spark.read.parquet(source).schema, out, checkpoint, lambda s: s, keys=["k"], time="ts", late="30 days")
    taken = spark.read.parquet(out)
    # the fourth landing comes after the state has let the key go; the read takes the first
    assert sorted((r["k"], r["v"]) for r in taken.collect()) == [(1, 1), (1, 7), (2, 1), (3, 1), (4, 1)]
    assert sorted((r["k"], r["v"]) for r in ingest.first_delivery(taken, ["k"]).collect()) == [(1, 1), (2, 1), (3, 1), (4, 1)]


def test_backlog_leaves_the_landed_table_where_it_is(spark, tmp_path):
    rows = spark.range(1000).selectExpr("cast(id AS string) AS entity_id", "concat('e', id % 2) AS endpoint_key")
    sinks.write_bucketed(rows.where("entity_id % 3 = 0"), "landed_in_test", f"{tmp_path}/landed", ["entity_id", "endpoint_key"], 4)
    left = combine.backlog_of_table(rows, "landed_in_test", ["entity_id", "endpoint_key"])
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert left.count() == 666 and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    spark.sql("DROP TABLE landed_in_test")


def test_collated_keys(spark):
    look = spark.createDataFrame([("Forlì", "b"), ("FORLI", "a"), (None, "n")], "place string, class string")
    rows = spark.createDataFrame([("forlí",), ("Forli",), ("Cesena",), (None,)], "place string")
    got = {r["place"]: r["class"] for r in enrich.lookup_with_default(rows, look, "place", "class", "none", collation="UNICODE_CI_AI").collect()}
    assert got == {"forlí": "a", "Forli": "a", "Cesena": "none", None: "none"}


def test_document_files_are_written_by_tasks_and_read_as_bytes(spark, tmp_path):
    docs = [("e1", "a", '{"x": 1}'), ("e 2/é+", "_b.c", "{broken"), ("e1", "empty", ""), ("e3", "a", "[1,\n2]")]
    rows = spark.createDataFrame(docs, "entity_id string, endpoint_key string, body string").repartition(3)
    assert sinks.write_document_files(rows, f"{tmp_path}/docs") == 4
    assert len([f for f in (tmp_path / "docs").rglob("*") if f.is_file()]) == 4  # no checksums, no other files
    read = csv.read_documents(spark, f"file://{tmp_path}/docs")
    got = {tuple(r) for r in read.select(F.url_decode("entity_id"), F.url_decode(F.url_decode("endpoint_key")), "body", "ok").collect()}
    assert got == {(*d, d[0] != "e 2/é+") for d in docs if d[2]}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan
    with pytest.raises(Exception, match="no file can be written"):
        sinks.write_document_files(spark.createDataFrame([("e", None, "x")], rows.schema), f"file://{tmp_path}/more")
