import gzip
import random

import pytest

from gleanery.functions.text import STOP_WORDS
from gleanery.sources.articles import (
    as_documents,
    extract_articles,
    file_names,
    parse_records,
    read_articles,
    read_files,
    read_records,
)
from gleanery.sources.movies import read_movies
from gleanery.sources.sensors import (
    SENSORS,
    complete_readings,
    read_checked_runs,
    read_runs,
    reading_problems,
)
from gleanery.sources.stopwords import read_stop_words

ARTICLES = """<doc id="1" url="http://x/1" title="Alpha">
Alpha

text one
</doc>
<doc id="2" url="http://x/2" title="">
body
</doc>
<doc id="3" url="http://x/3" title="Empty">
</doc>
<doc id="5" url="http://x/5">
no title
</doc>
<doc id="4" url="http://x/4" title="NoClose">
lost
"""


def test_article_extraction(spark, tmp_path):
    folder = tmp_path / "articles" / "AA"
    folder.mkdir(parents=True)
    (folder / "wiki_00").write_text(ARTICLES)
    files = read_files(spark, str(tmp_path / "articles" / "*" / "*"))
    rows = extract_articles(files).collect()
    assert [(r.wiki_id, r.url, r.title, r.content) for r in rows] == [
        ("1", "http://x/1", "Alpha", "Alpha\n\ntext one\n")
    ]


def test_content_restarts_at_each_header(spark):
    text = 'noise\n<doc id="1" title="a">\nlost\n<doc id="2" title="b">\nkept </doc> inline\n</doc>\ntail\n</doc>\n'
    rows = extract_articles(spark.createDataFrame([("f", text)], "path string, text string"))
    assert [(r.title, r.content) for r in rows.collect()] == [("b", "kept </doc> inline\n")]


def test_articles_from_many_files_and_samples(spark, tmp_path):
    folder = tmp_path / "articles" / "AA"
    folder.mkdir(parents=True)
    for i in range(40):
        record = f'<doc id="{i}" url="u" title="T{i}">\nbody {i}\n</doc>\n'
        (folder / f"wiki_{i:02d}").write_text(record)
    glob = str(tmp_path / "articles" / "*" / "*")
    docs = read_articles(spark, glob)
    assert docs.count() == 40 and docs.select("doc_id").distinct().count() == 40
    sampled = {r.title for r in read_articles(spark, glob, 0.5, seed=3).collect()}
    assert 5 < len(sampled) < 35
    assert sampled == {r.title for r in read_articles(spark, glob, 0.5, seed=3).collect()}


def test_stop_words(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("the\nits\nits\nours \n")
    words = {r.word for r in read_stop_words(spark, str(path)).collect()}
    assert words == {"the", "its", "ours "}
    built_in = read_stop_words(spark)
    assert built_in == STOP_WORDS and len(built_in) == len(set(built_in)) == 214
    assert {"aren't", "arent", "were", "wouldnt", "###"} <= set(built_in)
    assert not {"hell", "well", "ours"} & set(built_in)


def test_movies(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text(
        "Release Year,Title,Origin/Ethnicity,Director,Cast,Genre,Wiki Page,Plot\n"
        '1990,Same,American,D,C,"a, b ,c,d,e,f",w1,"first ""quoted"" line\nsecond line"\n'
        "1991,Same,American,D,C,drama / war,w2,other plot\n"
        "1992,None,American,D,C,drama,w3,\n"
        "19x2,Odd,American,D,C,,w4,plot\n"
    )
    rows = {(r.title, r.genre): r for r in read_movies(spark, str(path)).collect()}
    assert set(rows) == {("Same", "a, b ,c,d,e,f"), ("Same", "drama / war"), ("Odd", "Unknown")}
    assert rows["Same", "a, b ,c,d,e,f"].text == 'first "quoted" line\nsecond line'
    assert len({r.doc_id for r in rows.values()}) == 3


def test_sensor_runs(spark, tmp_path):
    (tmp_path / "Run_7.csv").write_text("1.0,2.0,3.0\n4.0,x,6.0\n7,8\n1,2,3,4\n")
    (tmp_path / "other.csv").write_text("1,2,3\n")
    readings = read_runs(spark, str(tmp_path / "*.csv"))
    rows = sorted(
        (tuple(r[c] for c in [*SENSORS, "runId"]) for r in readings.collect()), key=str
    )
    assert rows == sorted(
        [
            (1.0, 2.0, 3.0, 7), (4.0, None, 6.0, 7), (7.0, 8.0, None, 7), (1.0, 2.0, 3.0, 7),
            (1.0, 2.0, 3.0, None),
        ],
        key=str,
    )
    assert complete_readings(readings, SENSORS).count() == 3


def test_missing_checkpoint_folder_is_an_error_on_a_cluster():
    from gleanery.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_checkpoints_go_to_the_configured_folder(spark):
    from gleanery.session import checkpoint_dir, staged

    folder = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == folder
    assert staged(spark.range(3)).count() == 3
    assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(folder)


def test_size_check(spark):
    from gleanery.session import fits

    words = spark.range(100).selectExpr("cast(id as string) AS word")
    assert fits(words, 100) and not fits(words, 99) and not fits(words, 100, max_bytes=50)


def test_tables_are_spread_only_on_request(spark):
    from gleanery.session import SPREAD, spread

    one = spark.range(100).coalesce(1)
    assert spread(one, "id") is one
    spark.conf.set(SPREAD, "true")
    try:
        assert spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset(SPREAD)


def test_staged_tables_run_once(spark):
    from gleanery.session import staged

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kept = staged(spark.range(50).mapInArrow(count, "id long"))
    assert kept.count() == kept.count() == 50 and seen.value == 50


def test_equal_movie_rows_are_documents_of_their_own(spark, tmp_path):
    from gleanery.operators.terms import term_frequencies
    from gleanery.operators.tokens import tokenize_pattern
    from gleanery.sources.movies import read_movies

    line = '1999,Same,X,D,C,"g",w,"dragon dragon castle dragons"'
    head = "Release Year,Title,Origin/Ethnicity,Director,Cast,Genre,Wiki Page,Plot"
    (tmp_path / "m.csv").write_text("\n".join([head, line, line]) + "\n")
    docs = read_movies(spark, str(tmp_path / "m.csv"))
    found = term_frequencies(tokenize_pattern(docs, [])).collect()
    assert len({r.doc_id for r in found}) == 2
    assert sorted((r.term, r.tf, r.doc_len) for r in found) == sorted(
        [("dragon", 2, 4), ("castle", 1, 4), ("dragons", 1, 4)] * 2
    )


def test_records_of_split_files(spark, tmp_path):
    """A file that several tasks read gives the articles, positions and ids of the whole file."""
    rng = random.Random(6)
    words = "ü α 日本 word \u00a0 <doc </doc> \r".split(" ")
    for f in range(5):
        records = []
        for i in range(rng.choice([0, 1, 40])):
            body = "\n".join(" ".join(rng.choices(words, k=rng.choice([1, 30]))) for _ in range(rng.choice([1, 9])))
            title = "" if i % 11 == 3 else f"T{f}-{i}"
            records.append(f'<doc id="{i}" url="u" title="{title}">\n{body}\n</doc>')
        tail = ["", "\n", '\n<doc id="9" url="u" title="Open">\nnever closed', "\n\n</doc>\n", "\nx"][f]
        (tmp_path / f"wiki_{f}").write_bytes(("\n".join(records) + tail).encode())
    (tmp_path / "empty").write_text("")
    (tmp_path / "only_open").write_text('<doc id="1" url="u" title="O">\nno end')
    (tmp_path / "blank_first").write_text('\n</doc>\n<doc id="1" url="u" title="B">\nbody\n\n</doc>')
    key = "spark.sql.files.maxPartitionBytes"
    before = {k: spark.conf.get(k) for k in (key, "spark.sql.files.openCostInBytes")}
    whole = extract_articles(read_files(spark, str(tmp_path)))
    want = sorted(map(tuple, whole.collect()))
    ids = sorted(map(tuple, as_documents(whole).collect()))
    assert {w[4] for w in want} >= {"B"} and "Open" not in {w[4] for w in want} and "O" not in {w[4] for w in want}
    try:
        for size in ("1g", "700", "64"):
            spark.conf.set(key, size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0" if size != "1g" else "4m")
            records = read_records(spark, str(tmp_path))
            if size == "64":
                assert spark.read.option("lineSep", "\n</doc>").text(str(tmp_path)).rdd.getNumPartitions() > 20
            assert sorted(map(tuple, parse_records(records).collect())) == want
            assert sorted(map(tuple, read_articles(spark, str(tmp_path)).collect())) == ids
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert file_names(spark, str(tmp_path)).count() == 7  # Spark lists no empty file


def test_packed_files_keep_their_last_record(spark, tmp_path):
    with gzip.open(tmp_path / "wiki.gz", "wt") as f:
        f.write('<doc id="1" url="u" title="A">\nx\n</doc>\n<doc id="2" url="u" title="B">\ny\n</doc>')
    assert sorted(r.title for r in read_articles(spark, str(tmp_path)).collect()) == ["A", "B"]


def test_sensor_line_problems(spark, tmp_path):
    (tmp_path / "Run_4.csv").write_text("1,2,3\n1,2\n1,x,3\n1,2,3,4\n,2,3\n5\n")
    checked = read_checked_runs(spark, str(tmp_path))
    found = {r.problem: (r.runId, r.lines, r.usable) for r in reading_problems(checked).collect()}
    assert found == {"too short": (4, 2, 0), "not a number": (4, 1, 0), "extra fields": (4, 1, 1), "missing value": (4, 1, 0)}
    assert complete_readings(read_runs(spark, str(tmp_path)), SENSORS).count() == 2
