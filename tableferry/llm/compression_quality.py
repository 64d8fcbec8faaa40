"""Quality classifier: texts compressed with a dictionary of good and one of bad text.

Two zstandard dictionaries are built from labelled texts. A text that the dictionary of good
text shortens more is like good text; the difference of the compressed sizes, per byte, is
turned into a probability by a logistic curve fitted on other labelled texts. A text is
compressed in chunks, so that the dictionaries matter as much at its end as at its start.

Fitting takes a bounded sample of labelled rows (``SAMPLE``). Scoring is one pass over all
documents without a shuffle; the model (two dictionaries) is about 130 KB.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import tidy

#: Labelled rows used for fitting, chosen by the hash of their id: the first half for the
#: dictionaries, the second for the curve.
SAMPLE = 6000
CHUNK = 2048
#: Chunks of one sampled text that go into a dictionary, spread evenly over it.
CHUNKS_PER_TEXT = 8
DICTIONARY = 64 * 1024
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Dictionaries of bad and good text, and the curve 1 / (1 + exp(-(slope * x + offset)))."""

    bad: bytes
    good: bytes
    slope: float = 0.0
    offset: float = 0.0
    chunk: int = CHUNK
    level: int = LEVEL


def chunks(raw: bytes, size: int) -> list[bytes]:
    return [raw[at: at + size] for at in range(0, len(raw), size)]


def dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; with too few samples to train one, the samples themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Differences:
    """Compressed size with the bad dictionary less that with the good one, per byte."""

    def __init__(self, model: Model):
        import zstandard

        self.size = model.chunk
        self.compress = [
            zstandard.ZstdCompressor(
                level=model.level, write_content_size=False, write_checksum=False, write_dict_id=False,
                **({"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {})).compress
            for raw in (model.bad, model.good)]

    def __call__(self, text: str | None) -> float:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw:
            return 0.0
        bad, good = self.compress
        return sum(len(bad(c)) - len(good(c)) for c in chunks(raw, self.size)) / len(raw)


def curve(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression, by Newton's method with a slight penalty."""
    if not len(x):
        return 0.0, 0.0
    scale = float(np.abs(x).max()) or 1.0
    rows, weight = np.column_stack((x / scale, np.ones(len(x)))), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weight, -30, 30)))
        slope = rows.T @ (label - p) - 1e-3 * weight
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2), slope)
        weight += step
        if np.abs(step).max() < 1e-9:
            break
    return float(weight[0] / scale), float(weight[1])


def fit(documents: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text: str = "text", label: str = "quality",
        sample: int = SAMPLE, chunk: int = CHUNK, per_text: int = CHUNKS_PER_TEXT, size: int = DICTIONARY, level: int = LEVEL) -> Model:
    """A model from at most ``sample`` labelled rows, those whose id has the smallest hash.

    Labels other than 0 and 1, null ids and labels of absent documents are ignored. The driver
    gets ``sample * per_text`` chunks at most. Without labels every text scores 0.5.
    """
    order = F.xxhash64(F.col(id_column).cast("string"))
    chosen = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("__key"), F.col(label).cast("int").alias("__label"), order.alias("__order"))
    chosen = chosen.orderBy("__order", "__key", "__label").limit(sample)
    texts = documents.select(F.col(id_column).alias("__id"), F.col(text).alias("__text")).join(
        F.broadcast(chosen), F.col("__id") == F.col("__key")).select("__key", "__label", "__text")
    half = F.pmod(F.shiftright(F.xxhash64(F.col("__key").cast("string"), F.lit("half")), 7), F.lit(2))

    def sampled(batches):
        for batch in batches:
            out = {"label": [], "chunk": []}
            for mark, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = chunks((value or "").encode("utf-8", "surrogatepass"), chunk)
                for n in sorted({round(k * (len(found) - 1) / max(1, per_text - 1)) for k in range(per_text)}) if found else ():
                    out["label"].append(mark)
                    out["chunk"].append(found[n])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("label", pa.int32()), ("chunk", pa.binary())]))

    rows = texts.where(half == 0).select("__label", "__text").mapInArrow(sampled, "label int, chunk binary").collect()
    parts = [sorted(bytes(r["chunk"]) for r in rows if r["label"] == mark) for mark in (0, 1)]
    model = Model(dictionary(parts[0], size), dictionary(parts[1], size), chunk=chunk, level=level)
    scored = compression_quality(texts.where(half == 1), model, text="__text", into="__found").select("__label", "__found.difference").collect()
    slope, offset = curve(np.array([r["difference"] for r in scored]), np.array([r["__label"] for r in scored], float))
    return Model(model.bad, model.good, slope, offset, chunk, level)


def compression_quality(documents: DataFrame, model: Model, *, text: str = "text", into: str = "quality_score") -> DataFrame:
    """``documents`` with one more column, a struct of ``difference``, ``score`` and ``predicted``.

    ``score`` (0 to 1) is the probability that a text is good, ``predicted`` is 1 from 0.5 on.
    A null or empty text has the difference 0. All rows and columns of ``documents`` stay,
    repeated rows too; a column named ``into`` is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = [c for c in documents.columns if c != into]
    at, last = names.index(text), len(names)
    frame = documents.select(*names, F.lit(None).cast("struct<difference: double, score: double, predicted: int>").alias(into))

    def add(batches):
        model = shared.value
        differences = Differences(model)
        for batch in batches:
            x = np.array([differences(v.as_py()) for v in batch.column(at)], float)
            score = 1 / (1 + np.exp(-np.clip(model.slope * x + model.offset, -700, 700)))
            found = pa.StructArray.from_arrays(
                [pa.array(x), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], fields=list(batch.schema.field(last).type))
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], found], names=batch.schema.names)

    return frame.mapInArrow(tidy(add), frame.schema)
