import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
EDGE_TEXTS = [None, "", " \n\t ", "one", "two words", "the same", "the same", "Ünïcode ßtraße 日本語 😀 x",
              "a b c d e f g h " * 3000, "x" * 40000, "<|endoftext|> mixed <|startoftext|>Text", "tab\tand\x0bfeed\x1c \x00"]


@pytest.fixture(scope="session")
def sf():
    return SF


def edge_rows():
    """(doc_id, text, lang, source, n_chars): nulls in every column, empty,
    blank and very long texts, repeated rows, extra columns."""
    rows = [(900 + i, t, "en", "s", len(t or "")) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[5], rows[5], (None, "a text without an id here", None, None, None), (None, None, None, None, None)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def edge(spark):
    """Edge rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in (
        "score", "block", "sig", "node", "units", "part", "label", "labels", "found", "cells", "held_out",
        "component_id", "text_sha", "length", "start", "item", "_bucket2")])


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")
