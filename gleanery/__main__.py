"""Command line: ``python -m gleanery corpus|search|movies|sensors|sweep ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.plans import corpus, movies, sensors, sweep
from gleanery.session import build_session
from gleanery.sources.articles import read_articles
from gleanery.sources.stopwords import read_stop_words


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="gleanery")
    top.add_argument("--master")
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("corpus", help="fit and save an LSA model of article files")
    job.add_argument("articles", help="glob of the article files")
    job.add_argument("out", help="folder for the model")
    job.add_argument("--sample", type=float, default=corpus.SAMPLE)
    job.add_argument("--num-terms", type=int, default=corpus.NUM_TERMS)
    job.add_argument("-k", type=int, default=corpus.CONCEPTS)
    job.add_argument("--variant", choices=[corpus.LEMMA, corpus.PATTERN], default=corpus.LEMMA)
    job.add_argument("--stop-words")

    job = jobs.add_parser("search", help="search a saved model")
    job.add_argument("model")
    job.add_argument("queries", help="comma-separated queries")

    job = jobs.add_parser("movies", help="concepts and queries over movie plots")
    job.add_argument("movies", help="CSV path")
    job.add_argument("out", help="folder for the model")
    job.add_argument("--stop-words")

    job = jobs.add_parser("sensors", help="K-means sweep and outliers over sensor runs")
    job.add_argument("runs", help="glob of the CSV files")
    job.add_argument("--out", help="folder for the sampled export")

    job = jobs.add_parser("sweep", help="fit the grid of tokenizers, vocabularies and k")
    job.add_argument("articles")
    job.add_argument("out")
    job.add_argument("--sample", type=float, default=0.02)
    job.add_argument("--stop-words")
    return top


def show_all(table: DataFrame) -> None:
    """Print every row; the reports are bounded by the parameters of the job."""
    table.show(max(1, table.count()), False)


def show_hits(hits: DataFrame) -> None:
    ranked = hits.orderBy("query_id", "rank")
    show_all(ranked.withColumn("score", F.format_number("score", 4)))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"gleanery {args.job}", args.master)
    if args.job == "corpus":
        report = corpus.run_corpus(
            spark, args.articles, args.out, args.stop_words, args.sample, args.num_terms,
            args.k, args.variant,
        )
        show_all(report.counts)
        report.preview.show()
        show_all(report.singular_values.orderBy("concept"))
        show_all(report.names.orderBy("concept", F.desc("kind")))
        show_hits(report.trial)
    elif args.job == "search":
        show_hits(corpus.run_search(spark, args.model, args.queries))
    elif args.job == "movies":
        found = movies.run_movies(spark, args.movies, args.out, args.stop_words)
        show_all(found.counts)
        found.preview.show()
        show_all(found.concept_terms.orderBy("concept", "rank"))
        show_all(found.concept_docs.orderBy("concept", "rank"))
        show_hits(found.hits)
    elif args.job == "sensors":
        found = sensors.run_sensors(spark, args.runs, args.out)
        print(f"{found.readings} readings, {found.dropped} dropped for a missing sensor")
        for table in (found.sample, found.centers, found.outliers, found.sizes, found.elbow.orderBy("k")):
            show_all(table)
    else:
        docs = read_articles(spark, args.articles, args.sample)
        show_all(sweep.sweep_lsa(docs, read_stop_words(spark, args.stop_words), out=args.out))


if __name__ == "__main__":
    main()
