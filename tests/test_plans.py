import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanery import __main__ as cli
from gleanery.plans.corpus import run_corpus, run_search
from gleanery.plans.movies import run_movies
from gleanery.plans.sensors import run_sensors
from gleanery.plans.sweep import sweep_lsa
from gleanery.sources.articles import read_articles

WORDS = (
    "serious incident running runners nations nation calendar julian domini county states "
    "household census submarine enterprise calendars incidents the and 1050 3.14"
).split()


@pytest.fixture(scope="module")
def articles(tmp_path_factory):
    rng = random.Random(5)
    root = tmp_path_factory.mktemp("articles")
    for f in range(4):
        folder = root / f"A{f % 2}"
        folder.mkdir(exist_ok=True)
        records = [
            f'<doc id="{f}{i}" url="u" title="Doc {f}-{i}">\n'
            + " ".join(rng.choices(WORDS, k=30)) + "\n</doc>\n"
            for i in range(15)
        ]
        (folder / f"wiki_{f}").write_text("".join(records))
    return f"{root}/*/*"


@pytest.mark.parametrize("variant", ["lemma", "pattern"])
def test_corpus_job_and_search(spark, articles, tmp_path, variant):
    report = run_corpus(spark, articles, str(tmp_path), sample=1.0, num_terms=10, k=4, variant=variant)
    assert report.path == f"{tmp_path}/{variant}/model_terms10_k4"
    assert report.model.num_docs == 60 and report.singular_values.count() == 4
    names = report.names.collect()
    assert {(r.concept, r.kind) for r in names} == {(c, k) for c in range(4) for k in ("doc", "term")}
    terms = {r.term for r in report.model.term_factors.collect()}
    if variant == "lemma":
        assert "nation" in terms and "nations" not in terms
    hits = run_search(spark, report.path, "serious incident, julian calendar")
    assert hits.groupBy("query_id").count().collect()[0]["count"] == 10
    assert all(r.title.startswith("Doc ") for r in hits.collect())


def test_movie_job(spark, tmp_path):
    rng = random.Random(2)
    plots = ["war battle soldier", "love romance wedding", "space alien robot", "murder mystery police"]
    lines = ["Release Year,Title,Origin/Ethnicity,Director,Cast,Genre,Wiki Page,Plot"]
    for i in range(40):
        words = " ".join(rng.choices(plots[i % 4].split(), k=12))
        lines.append(f'19{i:02d},Movie {i},X,D,C,"g{i % 4}, b, c, d, e, f",w{i},"{words}"')
    path = tmp_path / "movies.csv"
    path.write_text("\n".join(lines) + "\n")
    report = run_movies(spark, str(path), str(tmp_path / "model"), num_terms=12, k=4)
    first = report.hits.filter("query_id = 1 AND rank = 1").first()
    assert first.genre.startswith("g0") and first.score > 0
    docs = report.concept_docs.collect()
    assert all(len(r.genres) == 5 for r in docs)
    assert report.concept_terms.filter("concept = 0").count() == 12


def test_sensor_job(spark, tmp_path):
    rng = random.Random(4)
    for run in (1, 2):
        lines = [",".join(str(rng.gauss(0, 1)) for _ in range(3)) for _ in range(300)]
        (tmp_path / f"Run_{run}.csv").write_text("\n".join([*lines, "1,x,2"]) + "\n")
    out = tmp_path / "export"
    report = run_sensors(spark, str(tmp_path / "Run_*.csv"), str(out), ks=[2, 3])
    assert (report.readings, report.dropped) == (600, 2)
    assert report.sizes.groupBy("k").agg(F.sum("size").alias("n")).collect()[0].n == 600
    assert report.outliers.groupBy("k").count().collect()[0]["count"] == 25
    assert {r.runId for r in report.outliers.collect()} <= {1, 2}
    assert report.elbow.count() == 2 and report.centers.count() == 5
    assert out.exists()


def test_sweep(spark, articles, tmp_path):
    docs = read_articles(spark, articles)
    rows = sweep_lsa(
        docs, ["the", "and"], variants=["pattern"], num_terms=[4, 8], concepts=[2, 4], out=str(tmp_path)
    ).collect()
    assert [(r.num_terms, r.k, r["rank"]) for r in rows] == [(4, 2, 2), (4, 4, 4), (8, 2, 2), (8, 4, 4)]
    full = {(r.num_terms, r.k): r.share for r in rows}
    assert full[4, 4] == pytest.approx(1.0) and full[8, 2] < full[8, 4] < 1.0
    assert run_search(spark, f"{tmp_path}/pattern/model_terms8_k4", "serious").count() == 10


def test_command_line(spark, articles, tmp_path, capsys):
    cli.main(["corpus", articles, str(tmp_path), "--sample", "1", "--num-terms", "8", "-k", "3", "--variant", "pattern"])
    cli.main(["search", f"{tmp_path}/pattern/model_terms8_k3", "serious"])
    shown = capsys.readouterr().out
    assert "Doc " in shown and "sigma" in shown


def test_jobs_free_what_they_hold(spark, articles, tmp_path):
    """After a job nothing is cached, no broadcast of it is usable and only its reports are staged."""
    from gleanery import session

    def stages():
        folder = Path(session._scratch_root(spark).removeprefix("file:"))
        return {p.name for p in folder.glob("stage-*")} if folder.exists() else set()

    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size
    before, cached = stages(), held()
    run_corpus(spark, articles, str(tmp_path), sample=1.0, num_terms=8, k=3)
    assert len(stages() - before) == 1 and held() == cached  # its counts
    (tmp_path / "Run_1.csv").write_text("".join(f"{i % 7},{i % 5},{i % 3}\n" for i in range(60)))
    before = stages()
    report = run_sensors(spark, str(tmp_path / "Run_*.csv"), ks=[2, 3])
    assert len(stages() - before) == 4 and held() == cached  # outliers, elbow, sizes, problems
    assert report.sizes.count() == 5 and report.problems.count() == 0
    before = stages()
    with pytest.raises(RuntimeError):
        with session.job_scope():
            session.persisted(spark.range(5)).count()
            session.staged(spark.range(5))
            sent = session.shared(spark, [1])
            raise RuntimeError("lost")
    assert stages() == before and held() == cached
    with pytest.raises(Exception):
        spark.sparkContext.parallelize([1]).map(lambda _: sent.value).collect()


def test_sensor_job_without_readings(spark, tmp_path):
    (tmp_path / "Run_1.csv").write_text("1,x,2\n")
    report = run_sensors(spark, str(tmp_path / "Run_*.csv"), ks=[2])
    assert (report.readings, report.dropped) == (0, 1) and report.outliers.count() == report.sizes.count() == 0
    assert [(r.problem, r.lines) for r in report.problems.collect()] == [("not a number", 1)]
