"""The LSA model as Parquet tables in one folder, published at once.

A model is written to a folder of its own beside its place and renamed to it when all tables are there and a marker was
written last; a job lost before that leaves no model and nothing that blocks its place. Where renaming a
folder is not one step (object stores), the marker tells a whole model from a part of one.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import SparkSession

from gleanery.operators.lsa import LsaModel, with_u
from gleanery.session import delete_folder, file_system

TABLES = ["doc_factors", "term_factors", "singular_values", "meta"]
MARKER = "_COMPLETE"


def model_path(root: str, variant: str, num_terms: int, k: int) -> str:
    return f"{root}/{variant}/model_terms{num_terms}_k{k}"


def model_tables(model: LsaModel) -> dict:
    """The tables of a model to be written; U follows from US and the singular values."""
    spark = model.doc_factors.sparkSession
    meta = [(model.num_docs, model.num_terms, model.k)]
    return {
        "doc_factors": model.doc_factors.drop("u"),
        "term_factors": model.term_factors,
        "singular_values": model.singular_values,
        "meta": spark.createDataFrame(meta, "num_docs long, num_terms int, k int"),
    }


def save_model(model: LsaModel, path: str, mode: str = "error") -> None:
    """Every document keeps its id and title beside its factors. ``mode`` is ``error`` or ``overwrite``."""
    spark = model.doc_factors.sparkSession
    check_free(spark, path, mode)
    parent, name = path.rstrip("/").rsplit("/", 1)
    staging = f"{parent}/_{name}-{uuid.uuid4().hex}"
    try:
        for table, rows in model_tables(model).items():
            rows.write.parquet(f"{staging}/{table}")
        files, folder = file_system(spark, staging)
        files.create(files.makeQualified(_child(spark, folder, MARKER))).close()
        _, target = file_system(spark, path)
        if mode == "overwrite" or not is_complete(spark, path):
            files.delete(target, True)  # an older model, or what an older version left half done
        if files.exists(target) or not files.rename(folder, target):
            raise FileExistsError(f"there is a model at {path}")
    finally:
        delete_folder(spark, staging)


def _child(spark: SparkSession, folder, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, name)


def is_complete(spark: SparkSession, path: str) -> bool:
    files, folder = file_system(spark, path)
    return files.exists(_child(spark, folder, MARKER))


def check_free(spark: SparkSession, path: str, mode: str = "error") -> None:
    """Refuse a taken path before any work is done for it; a folder without a whole model is free."""
    if mode not in ("error", "errorifexists", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode != "overwrite" and is_complete(spark, path):
        raise FileExistsError(f"there is a model at {path}")


def load_model(spark: SparkSession, path: str) -> LsaModel:
    """Load a saved model; a missing marker or table or a mismatch of its sizes is an error."""
    if not is_complete(spark, path):
        raise FileNotFoundError(f"there is no complete model at {path}")
    frames = {}
    for name in TABLES:
        try:
            frames[name] = spark.read.parquet(f"{path}/{name}")
        except Exception as error:
            raise FileNotFoundError(f"model at {path} has no readable table {name}") from error
    return checked_model(frames, f"model at {path}")


def checked_model(frames: dict, where: str) -> LsaModel:
    """The model of its four tables, whose sizes have to agree."""
    meta = frames["meta"].first()
    sigmas = [r["sigma"] for r in frames["singular_values"].orderBy("concept").collect()]
    terms = frames["term_factors"].count()
    documents = frames["doc_factors"].count()
    if (len(sigmas), terms, documents) != (meta["k"], meta["num_terms"], meta["num_docs"]):
        raise ValueError(
            f"{where} has {documents} documents, {terms} terms and {len(sigmas)} concepts, "
            f"its meta table says {meta['num_docs']}, {meta['num_terms']} and {meta['k']}"
        )
    return LsaModel(
        doc_factors=with_u(frames["doc_factors"], np.array(sigmas)),
        term_factors=frames["term_factors"],
        singular_values=frames["singular_values"],
        num_docs=meta["num_docs"],
        num_terms=meta["num_terms"],
        k=meta["k"],
    )
