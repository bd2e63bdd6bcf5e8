"""License scans by diagonal voting.

Every run of K words of every text is hashed and joined in Spark with the places of the same runs
in license templates. A match votes for the diagonal (place in the text minus place in the
template). Votes are added up per diagonal, neighbouring diagonals (words inserted or left out)
are merged, and a merged span is verified by the share of the template's runs it holds in full.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clickwell.llm import common
from clickwell.llm.encoding import CACHE_WORDS, only
from clickwell.llm.toxicity import blocks

K = 3
SLACK = 3  # diagonals at most so far apart are one span
COVERAGE = 0.6  # share of a template's runs that verifies a span
BROADCAST_ROWS = 10_000

# Phrases that are reported wherever their words stand consecutively, with labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Wording of license notices, matched in parts as well.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu general public license as published by the free software foundation": "gpl",
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
}

# The words of a text whose A-Z are lower-cased; a capital is part of a word just so.
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)

RUNS = "row bigint, doc_id bigint, n_words bigint, place bigint, run bigint, check bigint"


class Hashes(dict):
    """Word -> row of `pairs`: two independent hashes of the word in lower case."""

    def __init__(self) -> None:
        super().__init__()
        self.pairs = array("Q")

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self.pairs) // 2
        self.pairs.frombytes(blake2b(word.translate(CAPITALS).encode("utf-8", "replace"), digest_size=16).digest())
        return row

    def forget(self) -> None:
        self.clear()
        self.pairs = array("Q")

    def of(self, words: list[str]) -> np.ndarray:
        only(self)
        if len(self) > CACHE_WORDS:
            self.forget()
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        return np.array(self.pairs, dtype=np.uint64).reshape(-1, 2)[at] if len(at) else np.zeros((0, 2), dtype=np.uint64)


_hashes = Hashes()


def runs_of(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, two hashes) of all runs of K words."""
    each = np.array([len(own) for own in words], dtype=np.int64)
    pairs = _hashes.of([w for own in words for w in own])
    text = np.repeat(np.arange(len(words)), each)
    place = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    last = len(text) - K + 1
    if last <= 0:
        return text[:0], place[:0], pairs[:0]
    mixed = np.zeros((last, 2), dtype=np.uint64)
    for i in range(K):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * ODD[0] + pairs[i:last + i] * ODD[i % 3]
    whole = text[:last] == text[K - 1:]
    return text[:last][whole], place[:last][whole], mixed[whole]


def templates(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(runs of all templates, one row per template): both small and fixed."""
    texts = [(words, label, True) for words, label in PHRASES.items()] + [
        (words, label, False) for words, label in NOTICES.items()]
    text, place, hashes = runs_of([words.split() for words, _, _ in texts])
    hashes = hashes.astype(np.int64)
    runs = spark.createDataFrame(
        [(int(t), int(p), int(h[0]), int(h[1])) for t, p, h in zip(text, place, hashes)],
        "template int, t_place bigint, t_run bigint, t_check bigint")
    about = spark.createDataFrame(
        [(i, label, phrase, len(words.split()) - K + 1) for i, (words, label, phrase) in enumerate(texts)],
        "about int, label string, phrase boolean, n_runs int")
    return runs, about


def all_runs(docs: DataFrame) -> DataFrame:
    """A row for each run of K words of each text, and one (place null) for the text itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RUNS.split(", ")]
        for b in batches:
            rows, ids, at = b.column(0).to_numpy(), b.column(1), 0
            for texts in blocks(b.column(2), 500_000):
                words = [WORDS.findall(t) for t in texts]
                text, place, hashes = runs_of(words)
                n = len(text)
                none = pa.nulls(n, pa.int64())
                hashes = hashes.view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[at + text]), none, none, pa.array(place),
                    pa.array(hashes[:, 0]), pa.array(hashes[:, 1])], names)
                none = pa.nulls(len(texts), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows[at:at + len(texts)]), ids.slice(at, len(texts)),
                    pa.array([len(w) for w in words], pa.int64()), none, none, none], names)
                at += len(texts)

    return docs.select(
        common.row_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), common.text_of().alias("text"),
    ).mapInArrow(run, RUNS)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, spans (array of label, phrase, start word, end
    word, coverage; verified ones only).

    Null texts are empty; texts without words have no spans; repeated rows are scanned alike.
    Whole texts are read, other columns are not. An empty table gives no rows.
    """
    spark = docs.sparkSession
    runs, about = templates(spark)
    # The templates are a fixed list; should it grow past the bound, Spark chooses the join.
    small = runs.count() <= BROADCAST_ROWS
    runs, about = (F.broadcast(runs), F.broadcast(about)) if small else (runs, about)
    # Both hashes have to agree: 128 bits of each run are compared.
    hits = common.written(all_runs(docs).join(
        runs, (F.col("run") == F.col("t_run")) & (F.col("check") == F.col("t_check")), "left",
    ).where("template IS NOT NULL OR place IS NULL").select(
        "row", "doc_id", "n_words", "place", "template", "t_place"), "hits")
    votes = hits.where("template IS NOT NULL").groupBy(
        "row", "template", (F.col("place") - F.col("t_place")).alias("diagonal"),
    ).agg(F.collect_set("t_place").alias("places"), F.min("place").alias("first"), F.max("place").alias("last"))
    votes = votes.join(about, F.col("template") == F.col("about"))
    # A phrase must stand on one diagonal, so its diagonals are never merged.
    across = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("phrase") | (F.col("diagonal") - F.lag("diagonal").over(across) > SLACK)
    merged = votes.withColumn("span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(across)).groupBy(
        "row", "template", "span", "label", "phrase", "n_runs",
    ).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("held"),
        F.min("first").alias("start"), (F.max("last") + K).alias("end"))
    coverage = F.col("held") / F.col("n_runs")
    verified = merged.where(F.when(F.col("phrase"), F.col("held") == F.col("n_runs")).otherwise(coverage >= COVERAGE))
    spans = verified.groupBy(F.col("row").alias("of")).agg(F.sort_array(F.collect_list(F.struct(
        "start", "end", "label", "phrase", coverage.alias("coverage")))).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return hits.where("place IS NULL").select("row", "doc_id", "n_words").join(
        spans, F.col("row") == F.col("of"), "left",
    ).select("doc_id", "n_words", F.coalesce("spans", none).alias("spans"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["phrase"])
    starts = F.transform(base, lambda s: s["start"])
    joined = lambda spans: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))))
    return scan(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"))
