"""Streams of raw pages, and exports in parts that are validated."""

from tenderlake.sources import csv_export as X
from tenderlake.sources import landing


def test_pages_arrive_as_a_stream(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    seen = []

    def drain():
        pages = landing.raw_pages(spark, str(land), stream=True, at_once=1)
        writer = pages.writeStream.foreachBatch(lambda batch, n: seen.append(sorted((r.path.rsplit("/", 1)[1], r.body) for r in batch.collect())))
        writer.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()

    for name in ("a", "b"):
        (land / f"{name}.html").write_text(f"<p>{name}\nx</p>")
    drain()
    (land / "c.html").write_text("<p>c</p>")
    drain()
    assert sorted(r for batch in seen for r in batch) == [("a.html", "<p>a\nx</p>"), ("b.html", "<p>b\nx</p>"), ("c.html", "<p>c</p>")] and max(map(len, seen)) == 1


def test_exports_in_parts_are_validated(spark, tmp_path):
    rows = spark.createDataFrame([("a", str(i), "=1+1", f"x\ny{i}") for i in range(20)], "source string, source_entity_id string, title_ru string, title_kk string").repartition(3)
    for folder, safe in (("good", True), ("bad", False)):
        X.export({"lots": rows}, str(tmp_path / folder), parts=True, excel_safe=safe)
        report = X.validate_export(spark, str(tmp_path / folder))
        assert report["files"][0]["rows"] == 20 and report["files"][0]["utf8_bom"] and report["valid"] == safe, report
    assert report["files"][0]["errors"] == ["formula_cells"]


def test_files_of_a_manifest_are_validated_in_one_job(spark, tmp_path):
    """Folders with spaces and signs, repeated headers, empty files, parts of different headers."""
    folder = tmp_path / "a b%20+ü"
    parts = folder / "lots-1"
    parts.mkdir(parents=True)
    (parts / "part-0.csv").write_text("\ufeffsource,source_entity_id\na,1\n", "utf-8")
    (parts / "part-1.csv").write_text("\ufeffsource,source_entity_id\na,1\n", "utf-8")
    (folder / "empty.csv").write_text("", "utf-8")
    (folder / "header.csv").write_text("\ufeffsource;source_entity_id\n", "utf-8")
    (folder / "twice.csv").write_text('\ufeffsource,t,t\na,"x\n,y",=1\nb,\ufffd,\ufffd\ufffd\n', "utf-8")
    mixed = folder / "lots-2"
    mixed.mkdir()
    (mixed / "part-0.csv").write_text("\ufeffsource,source_entity_id\na,1\n", "utf-8")
    (mixed / "part-1.csv").write_text("\ufeffsource_entity_id,source\n1,a\n", "utf-8")
    reports = X.validate_files(spark, [(f"{folder}/{name}", data) for name, data in (("lots-1", "lots"), ("empty.csv", "lots"), ("header.csv", "lots"), ("twice.csv", "documents"), ("lots-2", "lots"))])
    assert [(r["rows"], r["errors"]) for r in reports] == [(2, ["repeated_identity"]), (0, ["no_bom", "no_header"]), (0, []), (2, ["formula_cells", "lost_characters"]), (2, ["mixed_headers", "repeated_identity"])]
    assert reports[3]["replacement_characters"] == 3 and reports[2]["delimiter"] == ";"
    assert X.validate_files(spark, []) == []
