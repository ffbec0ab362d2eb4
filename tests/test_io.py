import datetime

import pytest
from pyspark.sql import functions as F

from texloam.config import CleanSpec
from texloam.operators import cleaning
from texloam.plans import stages
from texloam.session import ensure_checkpoint_dir
from texloam.sources import readers, writers
from texloam.streaming import files as streams


def rows(df):
    return sorted(tuple(r) for r in df.collect())


BAD_CSV = 'a,b\n1,x\n2\n3,y,z\n"4","line\nbreak ""q"""\n5,\n\n'


def test_tolerant_csv(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(BAD_CSV)
    got = readers.read_csv_tolerant(spark, str(path))
    assert rows(got) == [("1", "x"), ("4", 'line\nbreak "q"'), ("5", "")]
    # Counting or selecting one column must not bring malformed rows back.
    assert got.count() == 3 and got.select("a").count() == 3
    good, rejected = readers.read_csv_with_rejects(spark, str(path))
    assert good.count() == 3 and rejected.count() == 2


def test_bad_characters(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("a,b\n1,caf\xe9\n".encode("latin-1"))
    read = lambda policy: readers.read_csv_tolerant(spark, str(path), bad_characters=policy)
    assert rows(read("replace")) == [("1", "caf�")]
    assert rows(read("ignore")) == [("1", "caf")]
    with pytest.raises(Exception, match="could not be read"):
        read("strict").collect()
    latin = readers.read_csv_tolerant(spark, str(path), encoding="ISO-8859-1")
    assert rows(latin) == [("1", "café")]


def test_read_by_extension(spark, tmp_path):
    (tmp_path / "r.JSON").write_text('[{"a": 1, "b": {"c": 2}}, {"a": 3, "b": null}]')
    got = readers.read_table(spark, str(tmp_path / "r.JSON"))
    assert got.columns == ["a", "b"] and got.select("b.c").collect()[0][0] == 2
    (tmp_path / "t.dat").write_text(BAD_CSV)
    assert readers.read_table(spark, str(tmp_path / "t.dat"), tolerant=True).count() == 3
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_table(spark, str(tmp_path / "t.dat"))


def test_folder_runs(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "sub").mkdir(parents=True)
    (folder / "one.csv").write_text("text,n\nThe Cars were here again,1\n,\n")
    (folder / "two.csv").write_text("text,n\nSeven Dogs barked all night,2\n")
    (folder / "sub" / "three.csv").write_text("text,n\nx,3\n")
    assert len(readers.list_files(spark, str(folder))) == 2
    stages.process_folder(spark, str(folder), str(tmp_path / "out"))
    one = spark.read.option("header", True).csv(str(tmp_path / "out" / "cleaned_one.csv"))
    assert rows(one) == [("cars", "1")]
    spec = CleanSpec(split_methods=("camel",))
    stages.process_folder(spark, str(folder), str(tmp_path / "same"), spec, same_schema=True)
    both = spark.read.option("header", True).csv(str(tmp_path / "same" / "cleaned"))
    assert rows(both.select("source_file", "text")) == [("one", "cars"), ("two", "seven dogs barked night")]


def test_files_that_differ_in_their_extension_keep_their_outputs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("text,n\none two three four,1\n")
    (folder / "a.jsonl").write_text('{"text": "five six seven eight", "n": 2}\n')
    stages.process_folder(spark, str(folder), str(tmp_path / "out"))
    read = {n: spark.read.option("header", True).csv(str(tmp_path / "out" / f"cleaned_{n}.csv")).first().n for n in ("a_csv", "a_jsonl")}
    assert read == {"a_csv": "1", "a_jsonl": "2"}


def test_json_in_another_encoding(spark, tmp_path):
    (tmp_path / "x.jsonl").write_bytes('{"t": "caf\u00e9"}\n'.encode("latin-1"))
    assert readers.read_json(spark, str(tmp_path / "x.jsonl"), lines=True, encoding="ISO-8859-1").first().t == "caf\u00e9"


def test_keyword_rows_keep_other_columns(spark):
    found = spark.createDataFrame([("k", "t", 7)], "keyword string, text string, depth int")
    assert writers.keyword_rows(found, "now").columns[-2:] == ["context", "depth"]


def test_tutorial_file(spark, tmp_path):
    path = tmp_path / "tutorial.csv"
    path.write_text('topic,content\nloops,"<p>for x in y</p>"\nNULL,none\nbroken\n')
    stages.tutorial_file(spark, str(path), ["content"], str(tmp_path / "out.csv"))
    got = spark.read.option("header", True).csv(str(tmp_path / "out.csv"))
    assert rows(got.fillna("-")) == [("-", "-"), ("loops", " for x in y ")]
    assert list((tmp_path / "out.csv").glob("*.csv.gz"))


def test_exports(spark, tmp_path):
    table = spark.createDataFrame([(2, "b"), (1, None)], "k int, v string")
    paths = writers.export_table(table, str(tmp_path / "x"), ("csv", "json", "parquet"), stamp="s")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["x_s.csv", "x_s.json", "x_s.parquet"]
    assert spark.read.json(paths[1]).count() == 2
    with pytest.raises(ValueError, match="unsupported export"):
        writers.export_table(table, str(tmp_path / "x"), ("xlsx",))
    writers.write_sorted(table, str(tmp_path / "sorted"), ["k"])
    writers.append_links(table.select(F.coalesce("v", F.lit("-")).alias("link")), str(tmp_path / "l"))
    writers.append_links(table.select(F.coalesce("v", F.lit("-")).alias("link")), str(tmp_path / "l"))
    assert spark.read.text(str(tmp_path / "l")).count() == 4


def test_keyword_files(spark, tmp_path):
    found = spark.createDataFrame(
        [("Climate change!", "climate", "http://u", "t", "p", "text", None)],
        "keyword string, matched_keyword string, url string, title string, selector string, text string, context string",
    )
    now = datetime.datetime(2024, 1, 2, 3, 4, 5)
    writers.write_keyword_files(found, str(tmp_path / "csv"), "https://en.site.org/x", now=now)
    folder = next((tmp_path / "csv").glob("keyword_file=*"))
    assert folder.name == "keyword_file=climate_change__site_202401020304"
    header = next(folder.glob("*.csv")).read_text().splitlines()[0]
    assert header == "keyword,matched_keyword,url,title,selector,text,timestamp,context"
    writers.write_keyword_files(
        found, str(tmp_path / "two"), "https://en.site.org/x", now=now, keywords=["Climate change!", "none"]
    )
    alone = next((tmp_path / "two").glob("keyword_file=none_*")).glob("*.csv")
    assert [f.read_text().strip() for f in alone] == [header]
    writers.write_keyword_files(found, str(tmp_path / "json"), "https://en.site.org/x", "json", now)
    summary = spark.read.json(str(tmp_path / "json" / "summary")).first()
    assert (summary.items_count, summary.timestamp) == (1, "2024-01-02 03:04:05")


def test_stream_equals_batch(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    source = tmp_path / "in"
    docs.repartition(3).write.parquet(str(source))

    def job(df):
        return cleaning.clean_text(df.select("doc_id", "text"), ["text"])

    def run():
        stream = streams.read_stream(spark, str(source), docs.schema, max_files_per_trigger=1)
        out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
        streams.run_stream(stream, job, out, progress).awaitTermination()
        return spark.read.parquet(out)

    assert rows(run()) == rows(job(docs))
    # A second run finds nothing new; new files are appended.
    docs.limit(5).write.mode("append").parquet(str(source))
    assert run().count() == docs.count() + 5


def test_checkpoint_folder_comes_from_the_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_small_scans_are_spread_and_large_ones_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    assert readers.spread(docs, cores).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 10, numPartitions=9)
    assert readers.spread(wide, cores) is wide
