"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

Terms of a text are its words, pairs of words that follow each other, the written forms of words (runs of letters,
capitals, digits and signs), pairs of these, and how much repeats. Term weights use document frequencies over the
whole corpus. A bounded sample of labelled rows, at most VOTERS, gives a low-rank basis and the vectors that vote:
where ids repeat, that many rows by the hash of their id. Every document is projected, its cosines to all labelled vectors are computed in blocks, and the nearest vote with a weight that
falls with the angle.

Null and empty texts have no terms; they get the share of label 1 among the voters. Repeated rows are scored
each by themselves, rows without id too, which never vote. Labels that are null don't vote. Without any labelled
row every score is 0.5. Very long texts are counted whole, one at a time. Which of equally near neighbours vote is left
to the order of the voters, which is fixed. Further columns travel along untouched. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.textbytes import U, Words, chunks, mix, shingles, text_bytes

VOTERS = 4096  # bound of the labelled sample
TERMS = 4096  # hashed terms: a quarter each for forms, pairs of forms, words and pairs of words, the last 16 for repetition
WORD_WEIGHT = 0.5  # of words beside forms
RANK = 64
NEIGHBOURS = 25
BLOCK = 512  # documents compared or weighted at once

_FORM = np.arange(256, dtype=np.uint8)
_FORM[[*range(97, 123), *range(128, 256)]] = 97
_FORM[65:91] = 0x81
_FORM[48:58] = 48
_FORM[[0x20, *range(0x09, 0x0E)]] = 32


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Weighted term counts, a row per text."""
    rows, quarter = len(offsets) - 1, TERMS // 4
    form = _FORM[data]
    keep = np.ones(len(form), bool)
    keep[1:] = form[1:] != form[:-1]
    keep[offsets[:-1][offsets[:-1] < len(form)]] = True
    places = np.concatenate([[0], np.cumsum(keep)])[offsets]
    forms = Words(form[keep], places)
    words = Words(data, offsets)
    places = []
    for k, found in enumerate((forms, words)):
        pair = np.flatnonzero(found.row[1:] == found.row[:-1])
        begin = 2 * k * quarter
        places.append(found.row * TERMS + begin + (found.hash % U(quarter)).astype(np.int64))
        places.append(found.row[pair] * TERMS + begin + quarter
                      + (mix(found.hash[pair] * U(3) + found.hash[pair + 1]) % U(quarter - 16)).astype(np.int64))
    out = np.bincount(np.concatenate(places), minlength=rows * TERMS).reshape(rows, TERMS).astype(np.float32)
    for found, part in ((forms, slice(0, 2 * quarter)), (words, slice(2 * quarter, TERMS))):
        out[:, part] = np.sqrt(out[:, part] / np.maximum(np.diff(found.first), 1)[:, None])
    out[:, 2 * quarter:] *= WORD_WEIGHT
    n = np.maximum(np.diff(words.first), 1)
    same = words.row[1:][(words.hash[1:] == words.hash[:-1]) & (words.row[1:] == words.row[:-1])]
    stutter = np.bincount(same, minlength=rows) / n
    expected = 1 - np.bincount(shingles(words, 3)[1], minlength=rows) / np.maximum(n - 2, 1)
    out[:, -16:] = 0
    for column, share in ((-16, stutter), (-8, expected)):
        level = np.clip((share * 8).astype(int), 0, 7)
        out[np.arange(rows), column + level] = np.where(level > 0, 0.5, 0)
    return out


@dataclass(frozen=True)
class Voters:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, rows = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for i, j in chunks(offsets):
            seen += (terms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) > 0).sum(axis=0)
            rows += j - i
    yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(TERMS), -1)), pa.array(np.append(seen, rows))],
                                     names=["term", "n"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column(0))
        for i, j in chunks(offsets):
            dense = terms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            at = [np.flatnonzero(row) for row in dense]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([k.astype(np.uint16).tobytes() for k in at], pa.binary()),
                 pa.array([row[k].tobytes() for row, k in zip(dense, at)], pa.binary())], names=["doc_id", "label", "at", "value"])


def _weighted(sample: list, idf: np.ndarray) -> np.ndarray:
    """Weighted term vectors of length 1, a row per row of the sample; only the vectors themselves are held whole."""
    x = np.zeros((len(sample), TERMS), np.float32)
    for k, r in enumerate(sample):
        x[k, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float32)
    for k in range(0, len(x), BLOCK):
        x[k:k + BLOCK] = _unit(x[k:k + BLOCK] * idf)
    return x


def fit(docs: DataFrame, labelled: DataFrame, label: str, voters: int = VOTERS) -> Voters:
    """``labelled`` (doc_id, label) names the rows that may be learnt from; at most ``voters`` of them vote."""
    counted = docs.select("text").mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = dict(counted.collect())  # a row per hashed term
    total = found.get(-1, 0)
    idf = np.array([np.log((1 + total) / (1 + found.get(t, 0))) + 1 for t in range(TERMS)], np.float32)
    chosen = (labelled.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(voters))
    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "doc_id", "label")
            .mapInArrow(_sparse, "doc_id long, label int, at binary, value binary")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("at", "value")).limit(voters))
    sample = rows.collect()
    x = _weighted(sample, idf)
    basis = np.random.default_rng(7).standard_normal((TERMS, min(RANK + 16, TERMS))).astype(np.float32)
    for _ in range(4 if len(sample) else 0):  # subspace iteration towards the leading right singular vectors
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    if len(sample):
        _, _, turn = np.linalg.svd(x @ basis, full_matrices=False)
        basis = (basis @ turn.T)[:, :RANK]
    basis = np.ascontiguousarray(basis[:, :RANK])
    return Voters(idf, basis, _unit(x @ basis), np.array([r["label"] for r in sample], np.float32))


def votes(vectors: np.ndarray, model: Voters) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, weighted by how near they are."""
    if not len(model.labels):
        return np.full(len(vectors), 0.5)
    k, out = min(NEIGHBOURS, len(model.labels)), np.empty(len(vectors))
    for i in range(0, len(vectors), BLOCK):
        cosine = vectors[i:i + BLOCK] @ model.vectors.T
        near = np.argpartition(cosine, -k, axis=1)[:, -k:]
        weight = 1 / (0.02 + 1 - np.clip(np.take_along_axis(cosine, near, 1).astype(np.float64), 0, 1))
        out[i:i + BLOCK] = (weight * model.labels[near]).sum(1) / weight.sum(1)
    out[~vectors.any(axis=1)] = model.labels.mean()
    return np.clip(out, 0, 1)


def score(docs: DataFrame, model: Voters, column: str = "score") -> DataFrame:
    """The documents with a further column: how likely label 1 is, 0 to 1. Texts never cross a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(names.index("text")))
            for i, j in chunks(offsets):
                x = _unit((terms(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) * m.idf) @ m.basis)
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns), pa.array(votes(x, m), pa.float64())],
                                                 names=[*names, column])
        pa.default_memory_pool().release_unused()  # the worker lives on beside the executor's other stages
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def held_out(doc_id: str | Column, parts: int) -> Column:
    """Whether crc32 of the id as text leaves no remainder."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.crc32(text) % parts == 0


def fitted(docs: DataFrame, labels: DataFrame) -> Voters:
    """Learn quality from the labelled rows that are not held out."""
    return fit(docs, labels.where(~held_out("doc_id", 5)), "quality")
