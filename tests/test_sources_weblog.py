import datetime as dt
import gzip

from pyspark.sql import functions as F

from tableworks.operators import weblog as wl
from tableworks.sources import (
    read_access_log, read_claims, read_corpus, read_labelled_docs, read_numeric_csv,
    read_questions, read_ratings, read_report, read_tag_scores, read_tagged, read_tags,
)

GOOD = '199.72.81.55 - - [01/Jul/1995:00:00:01 -0400] "GET /history/apollo/ HTTP/1.0" 200 6245'


def _log(tmp_path, *lines):
    path = tmp_path / "log.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")
    return str(path)


def test_access_log_round_trip(spark, tmp_path):
    raw = read_access_log(spark, _log(
        tmp_path, GOOD,
        'h - - [bad -0400] "GET /x HTTP/1.0" 200 5',
        'h - - [02/Jul/1995:10:00:00 +0000] "GET" 404 -',
    ))
    rows = sorted(wl.parse_access_log(raw).collect())
    assert [tuple(r) for r in rows] == [
        ("199.72.81.55", dt.datetime(1995, 7, 1, 4, 0, 1), "/history/apollo/", 200, 6245),
        ("h", dt.datetime(1995, 7, 2, 10), None, 404, None),
    ]
    assert tuple(wl.parse_report(raw).first()) == (3, 1)


def test_zone_moves_the_date(spark, tmp_path):
    raw = read_access_log(spark, _log(tmp_path, GOOD))
    assert wl.parse_access_log(raw, "America/New_York").first().ts == dt.datetime(1995, 7, 1, 0, 0, 1)


def test_time_is_parsed_once(spark, tmp_path):
    plan = wl.parse_access_log(read_access_log(spark, _log(tmp_path, GOOD)))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("gettimestamp") == 1


def test_weekday_average(spark):
    days = [dt.datetime(2024, 1, 1)] * 3 + [dt.datetime(2024, 1, 8)]
    log = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    rows = [tuple(r) for r in wl.weekday_average(log).collect()]
    assert rows[0] == ("Mon", 4, 2, 2.0)
    assert rows[1:] == [(d, 0, 0, None) for d in ["Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]]
    assert wl.weekday_average(log, complete=False).count() == 1


def test_weekday_average_equals_the_join_of_two_aggregates(spark):
    days = [dt.datetime(2024, 1, 1 + i % 9) for i in range(50)]
    log = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz").withColumn(
        "day", F.date_format("ts", "E"))
    joined = log.groupBy("day").count().join(
        log.groupBy("day").agg(F.count_distinct(F.to_date("ts")).alias("number")), "day")
    expected = {(r.day, r["count"], r.number) for r in joined.collect()}
    got = {tuple(r)[:3] for r in wl.weekday_average(log, complete=False).collect()}
    assert got == expected


def test_top_values_ties_and_case(spark):
    df = spark.createDataFrame([(p,) for p in ["/b.gif", "/a.gif", "/a.GIF", "/c.gif?x", "/c.gif?x"]], "p string")
    assert [tuple(r) for r in wl.top_values(df, "p", "%.gif%", 2).collect()] == [("/c.gif?x", 2), ("/a.gif", 1)]


def test_parsing_runs_on_a_stream(spark, tmp_path):
    from tableworks.sources.readers import LOG_SCHEMA

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text(GOOD + "\n")
    stream = spark.readStream.csv(str(tmp_path / "in"), schema=LOG_SCHEMA, sep=" ")
    query = (
        wl.parse_access_log(stream).writeStream.format("memory").queryName("parsed")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    assert spark.table("parsed").first().bytes == 6245


def test_csv_readers(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,2,3.5,99\n")
    (tmp_path / "r3.csv").write_text("userId,movieId,rating\n1,2,3.5\n")
    (tmp_path / "s.csv").write_text("movieId,tagId,relevance\n1,7,0.25\n")
    (tmp_path / "t.csv").write_text("tagId,tag\n7,original\n")
    (tmp_path / "n.csv").write_text("1.0,2.5\n0.0,\n")
    assert tuple(read_ratings(spark, str(tmp_path / "r.csv")).first()) == (1, 2, 3.5)
    assert tuple(read_ratings(spark, str(tmp_path / "r3.csv")).first()) == (1, 2, 3.5)
    assert tuple(read_tag_scores(spark, str(tmp_path / "s.csv")).first()) == (1, 7, 0.25)
    assert tuple(read_tags(spark, str(tmp_path / "t.csv")).first()) == (7, "original")
    rows = read_numeric_csv(spark, str(tmp_path / "n.csv"), ["label", "x"]).collect()
    assert sorted(map(tuple, rows), key=repr) == [(0.0, None), (1.0, 2.5)]


def test_claims_null_marker(spark, tmp_path):
    from tableworks.sources.readers import CLAIM_SCHEMA

    names = [c.split()[0] for c in CLAIM_SCHEMA.split(", ")]
    values = ["1", "2", "3", "2005", "1999", "K", "K.1", "K.1.2"] + ["A"] * 12 + ["?"]
    values += ["0.5"] * 8 + ["N"] + ["1.5"] * 4 + ["0.0"]
    assert len(names) == len(values) == 35
    (tmp_path / "c.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    row = read_claims(spark, str(tmp_path / "c.csv")).first()
    assert row.OrdCat is None and row.Calendar_Year == "2005" and row.Model_Year == 1999
    assert row.NVVar4 == 1.5


def test_labelled_docs(spark, tmp_path):
    for folder, text in (("neg", "bad\nfilm"), ("pos", "good"), ("other", "skip")):
        (tmp_path / "t" / folder).mkdir(parents=True)
        (tmp_path / "t" / folder / "a.txt").write_text(text)
    rows = sorted(map(tuple, read_labelled_docs(spark, str(tmp_path / "t")).collect()))
    assert rows == [("neg/a.txt", "bad\nfilm", -1), ("pos/a.txt", "good", 1)]


def test_corpus_and_questions(spark, tmp_path):
    (tmp_path / "c.txt").write_text("The CAT, sat-on it.\n\n")
    (tmp_path / "q.txt").write_text("I don't know ____ to go . : whether/weather\n")
    tokens = [r.tokens for r in read_corpus(spark, str(tmp_path / "c.txt")).collect()]
    assert ["the", "cat", "saton", "it"] in tokens
    rows = sorted(read_questions(spark, str(tmp_path / "q.txt")).collect(), key=lambda r: r.cand_no)
    assert [(r.cand_no, r.cand) for r in rows] == [(1, "whether"), (2, "weather")]
    assert rows[0].tokens == ["i", "don't", "know", "____", "to", "go", "."]


def test_tagged_file(spark, tmp_path):
    (tmp_path / "t.txt").write_text('Rome " fell\tLOC O O\nonly words\n')
    path = str(tmp_path / "t.txt")
    arrays = read_tagged(spark, path).collect()
    assert [(r.words, r.tags) for r in arrays] == [(["Rome", '"', "fell"], ["LOC", "O", "O"])]
    assert read_tagged(spark, path, form="words").columns == ["sent_id", "words"]
    words = spark.createDataFrame([("Rome", 4)], "word string, ix bigint")
    tags = spark.createDataFrame([("LOC", 1), ("O", 0)], "tag string, ix bigint")
    rows = sorted(read_tagged(spark, path, words, tags, "rows").collect(), key=lambda r: r.pos)
    assert [(r.word, r.tag, r.word_ix, r.tag_ix) for r in rows] == [
        ("Rome", "LOC", 4, 1), ('"', "O", None, 0), ("fell", "O", None, 0)]


def test_documents_of_one_name_in_two_folders(spark, tmp_path):
    for part in ("train", "test"):
        for side in ("pos", "neg"):
            (tmp_path / part / side).mkdir(parents=True)
            (tmp_path / part / side / "1.txt").write_text(f"{part} {side}")
    got = {r.doc_id: (r.text, r.label) for r in read_labelled_docs(spark, str(tmp_path)).collect()}
    assert got == {f"{p}/{s}/1.txt": (f"{p} {s}", 1 if s == "pos" else -1) for p in ("train", "test") for s in ("pos", "neg")}


def test_lines_that_are_not_read_are_counted(spark, tmp_path):
    (tmp_path / "q").write_text("a ____ b : x/y\nno candidates\n")
    (tmp_path / "t").write_text("a b\tO O\nno tab\ntwo\ttabs\there\n")
    assert tuple(read_report(spark, str(tmp_path / "q"), "questions").first()) == (2, 1)
    assert tuple(read_report(spark, str(tmp_path / "t"), "tagged").first()) == (3, 1)
