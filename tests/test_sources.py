"""Readers of plain files, and text functions that need odd bytes."""

import pytest
from pyspark.sql import functions as F

from lettermill.functions import text as T
from lettermill.sources import readers, writers


def test_utf8_repair_drops_invalid_bytes_only(spark):
    rows = [(bytearray(b"a\xffb"),), (bytearray("café �".encode()),), (None,)]
    got = [r[0] for r in readers.repair_utf8(spark.createDataFrame(rows, "t binary"), "t").collect()]
    assert got == ["ab", "café �", None]


def test_letters_phrases_templates(spark, tmp_path):
    (tmp_path / "C1_appeal.txt").write_text("one\ntwo")
    (tmp_path / "phrases").write_text("Bad Word\n\n  \nbad\n")
    letters = readers.read_letters(spark, str(tmp_path)).collect()
    assert [(r["path"].rsplit("/", 1)[1], r["raw_text"]) for r in letters] == [("C1_appeal.txt", "one\ntwo")]
    phrases = readers.read_phrases(spark, {"denial": str(tmp_path / "phrases")}).collect()
    assert sorted(map(tuple, phrases)) == [("rejection", "bad"), ("rejection", "bad word")]
    templates = readers.read_templates(spark, {"head": str(tmp_path / "C1_appeal.txt")}).collect()
    assert [tuple(r) for r in templates] == [("head", "one\ntwo")]


def test_letter_files_are_one_file_a_letter(spark, tmp_path):
    rows = [(f"letters/C{i}_appeal.txt", f"one\n{i}") for i in range(20)]
    writers.write_letter_files(spark.createDataFrame(rows, "path string, raw_text string"), str(tmp_path / "out"), files=2)
    assert len([f for f in (tmp_path / "out").glob("path=*/*")] + [f for f in (tmp_path / "out").glob("path=*/.*")]) == 20
    got = readers.read_letters(spark, str(tmp_path / "out"), suffix="part-*").collect()
    assert sorted((r["path"], r["raw_text"]) for r in got) == sorted((p, t + writers.LETTER_END) for p, t in rows)


def test_workers_lay_letter_files_out_as_spark_does(spark, tmp_path):
    odd = "".join(map(chr, range(1, 128))).replace("/", "") + "é😀%41 ~"
    rows = [(odd, "odd"), ("a/b=c", "x\r\ny"), ("a/b=c", "x\r\ny"), (None, "n"), ("", ""), ("none", None), ("é", "\x00"), (" ", " ")]
    letters = spark.createDataFrame(rows, "path string, raw_text string").repartition(3)
    writers.write_letter_files(letters, f"file://{tmp_path}/out", files=2)
    letters.repartition(2, "path").write.partitionBy("path").text(f"{tmp_path}/plain")
    held = [{f.parent.name: f.read_bytes() for f in (tmp_path / top).glob("path=*/part-*")} for top in ("out", "plain")]
    assert {k: v for k, v in held[0].items() if k[5:7] != "__"} == {k: v for k, v in held[1].items() if k[5:7] != "__"} and held[0].keys() == held[1].keys()
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out", "plain"] and (tmp_path / "out/_SUCCESS").is_file() and not (tmp_path / "out/_begun").exists()
    found = readers.read_letters(spark, f"{tmp_path}/out", suffix="part-*")
    assert "MapInArrow" in found._jdf.queryExecution().toString()  # no folder is listed by the driver
    plain = readers.read_letters(spark, f"{tmp_path}/plain", suffix="part-*")
    named = [sorted(map(tuple, df.filter("path IS NOT NULL").collect())) for df in (found, plain)]
    assert named[0] == named[1] and len(named[0]) == 5 and ("a/b=c", "x\r\ny\nx\r\ny\n") in named[0]
    assert sorted("".join(sorted(r[1])) for r in found.filter("path IS NULL").collect()) in (["\n", "\nn"], ["\n\nn"])
    assert readers.read_letters(spark, f"{tmp_path}/out", suffix="*.csv").count() == 0
    with pytest.raises(FileExistsError):
        writers.write_letter_files(letters, f"{tmp_path}/out")


def test_names_of_letters_stay_as_they_are(spark, tmp_path):
    rows = [("007", "a"), ("1.50", "b"), ("12", "c")]  # Spark's reader takes such folder names for numbers
    writers.write_letter_files(spark.createDataFrame(rows, "path string, raw_text string"), str(tmp_path / "out"), files=2)
    assert sorted(r["path"] for r in readers.read_letters(spark, str(tmp_path / "out"), suffix="part-*").collect()) == ["007", "1.50", "12"]


def test_letter_files_that_fail_leave_nothing(spark, tmp_path):
    bad = spark.createDataFrame([("a", "x"), ("b", "y")], "path string, raw_text string").withColumn("path", F.concat("path", F.expr("repeat('x', 300)")))
    with pytest.raises(Exception):
        writers.write_letter_files(bad, str(tmp_path / "out"), files=1)
    assert not list(tmp_path.iterdir())


def test_articles(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<all><article><title>T</title><body>B</body></article><article><title>U</title></article></all>")
    got = readers.read_articles(spark, str(tmp_path), "title string, body string").collect()
    assert sorted((r["title"], r["body"]) for r in got) == [("T", "B"), ("U", None)]


def test_csv_keeps_line_feeds_and_quotes(spark, tmp_path):
    rows = [("a\nb", 'say "x", ok', None)]
    spark.createDataFrame(rows, "Name string, Category string, Remarks string").write.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "c"), ["Name", "Category", "Remarks"]).collect()] == rows


def test_control_characters_go_but_line_feeds_stay(spark):
    df = spark.createDataFrame([("a\x00b\nc​d\te",), (None,)], "t string")
    assert [r[0] for r in df.select(T.strip_control(F.col("t"))).collect()] == ["ab\ncde", None]
