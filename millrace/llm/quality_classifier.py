"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Features are single words and pairs of neighbours, once as they are (A-Z lower-cased) and once by
shape (letters as ``a`` or ``A``, digits as ``0``), each family's counts divided by its size, hashed
to ``CELLS`` weights. A score is a sparse dot product of these with the weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import id_remainder, least_ids

CELLS = 1 << 18
#: Labelled rows learned from, at most: those with the least hashes of their ids.
TRAIN_ROWS = 6000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.002, 0.01
HELD_OUT = 5
THRESHOLD = 0.3
_SHAPE = bytes(
    ord("A") if 65 <= c <= 90 else ord("a") if 97 <= c <= 122 or c >= 128 else ord("0") if 48 <= c <= 57 else c for c in range(256)
)


def cells(raw: bytes | None):
    """Cells of a text's features with repeats, and the value of each; cell 0 is the constant."""
    from zlib import crc32

    import numpy as np

    found, values = [np.zeros(1, np.uint32)], [np.ones(1, np.float32)]
    for family, words in enumerate(((raw or b"").lower().split(), (raw or b"").translate(_SHAPE).split())):
        n = len(words)
        if not n:
            continue
        h = np.fromiter(map(crc32, words), np.uint32, n)
        mixed = [h * np.uint32(0x9E3779B1) + np.uint32(family)]
        if n > 1:
            mixed.append((h[:-1] * np.uint32(0x85EBCA77)) ^ (h[1:] * np.uint32(0xC2B2AE3D) + np.uint32(family + 2)))
        for m in mixed:
            m = (m ^ (m >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            found.append(m >> np.uint32(32 - 18))
            values.append(np.full(len(m), 1 / len(m), np.float32))
    return np.concatenate(found), np.concatenate(values)


def summed(raw: bytes | None):
    """Distinct cells and their values."""
    import numpy as np

    at, value = cells(raw)
    own, place = np.unique(at, return_inverse=True)
    return own.astype(np.int64), np.bincount(place, value).astype(np.float64)


class Ftrl:
    """Follow-the-regularised-leader, per-coordinate rates, lazy weights."""

    def __init__(self):
        import numpy as np

        self.z, self.n = np.zeros(CELLS), np.zeros(CELLS)

    def weights(self, at=slice(None)):
        import numpy as np

        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at, value, label: int):
        import numpy as np

        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _summed_batches(batches):
    """The features of each id's row of the least hash, as far as a task can tell; an id once a task."""
    import pyarrow as pa

    held: dict = {}
    for batch in batches:
        ids, labels, hashes, marks = (batch.column(c).to_pylist() for c in ("doc_id", "label", "h", "k_text"))
        for k, raw in enumerate(batch.column("raw")):
            if ids[k] not in held or marks[k] < held[ids[k]][2]:
                at, value = summed(raw.as_py())
                held[ids[k]] = (labels[k], hashes[k], marks[k], at.astype("<i4").tobytes(), value.astype("<f4").tobytes())
    types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    columns = [pa.array([r[i] for r in held.values()], t) for i, t in enumerate(types)]
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), *columns], names=["doc_id", "label", "h", "k_text", "at", "value"])


def train(docs: DataFrame, labels: DataFrame):
    """Weights from at most ``TRAIN_ROWS`` rows whose id is not held out; None without any.

    Rows without a label of 0 or 1, and ids that are null, teach nothing. An id counts once, with its
    least label and the text of the least hash, however often its rows are repeated in either table.
    """
    import numpy as np

    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (id_remainder("doc_id", HELD_OUT) != 0))
    some = least_ids(known.select(F.lit("").alias("grp"), "doc_id", F.col("quality").alias("mark")), TRAIN_ROWS, TRAIN_ROWS)
    some = some.select("doc_id", F.col("mark").cast("int").alias("label"), "h")
    # The sample is bounded by TRAIN_ROWS, so it may be broadcast.
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("k_text"), F.col("text").cast("binary").alias("raw"))
    rows = slim.join(F.broadcast(some), "doc_id").select("doc_id", "label", "h", "k_text", "raw").mapInArrow(
        _summed_batches, "doc_id long, label int, h long, k_text long, at binary, value binary")
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy("k_text"))
    rows = rows.withColumn("one", one).where("one = 1").select("h", "label", "doc_id", "at", "value").toArrow().to_pylist()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["h"], r["doc_id"]))
    model = Ftrl()
    for _ in range(EPOCHS):
        for r in rows:
            model.learn(np.frombuffer(r["at"], "<i4"), np.frombuffer(r["value"], "<f4").astype(float), r["label"])
    return model.weights().astype(np.float32)


def score(docs: DataFrame, weights) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts are scored by the constant alone; without a model every score is 0.5. Null
    ids are not held out. Repeated rows each get their row; other columns are not looked at.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = np.full(batch.num_rows, 0.5)
            if weights is not None:
                for k, x in enumerate(batch.column("raw")):
                    at, value = cells(x.as_py())
                    out[k] = 1 / (1 + np.exp(-np.clip(float(weights[at] @ value), -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(out)], names=["doc_id", "held_out", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_remainder("doc_id", HELD_OUT) == 0).alias("held_out"), F.col("text").cast("binary").alias("raw"))
    return slim.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
