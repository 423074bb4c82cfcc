"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams of lengths ``ORDERS`` present in both, over the
root of the product of the numbers present in each (n-grams hashed to ``CELLS`` cells). Landmark
texts span a Nyström approximation, in which one-versus-rest kernel ridge regression is solved; a
batch is scored as its presence matrix times the landmarks' times the coefficients.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_remainder, least_ids

ORDERS = (1, 2, 3)
CELL_BITS = 13
CELLS = 1 << CELL_BITS
#: Texts learned from for each language, landmarks among them, and texts in all, at most.
PER_LANGUAGE, LANDMARKS, TRAIN_ROWS = 200, 40, 10_000
RIDGE = 0.1
HELD_OUT, HELD_OUT_BY = 2, 4
UNKNOWN = "und"
#: Bytes and texts of one matrix.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 256


def presence(raws: list[bytes]):
    """Matrix of texts by cells: which n-grams are present."""
    import numpy as np

    out = np.zeros((len(raws), CELLS), np.float32)
    joined = b"\0".join(x.lower() for x in raws)
    b = np.frombuffer(joined, np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(raws), dtype=np.int32), [len(x) + 1 for x in raws])[: len(b)]
    code = np.zeros(len(b), np.uint32)
    # The byte between texts is no part of an n-gram, nor is a zero byte within one.
    bad = np.zeros(len(b), bool)
    for n in range(1, max(ORDERS) + 1):
        if len(b) < n:
            break
        code = (code[: len(b) - n + 1] << np.uint32(8)) | b[n - 1 :]
        bad = bad[: len(b) - n + 1] | (b[n - 1 :] == 0)
        if n in ORDERS:
            cell = ((code + np.uint32(n << 24)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELL_BITS)
            good = ~bad
            out[row[: len(code)][good], cell[good]] = 1
    return out


def _slices(raws):
    first = size = 0
    for k, x in enumerate(raws):
        size += len(x)
        if size >= SLICE_BYTES or k + 1 - first >= SLICE_ROWS:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(raws):
        yield first, len(raws)


def _normal(matrix):
    import numpy as np

    return matrix / np.sqrt(np.maximum(matrix.sum(axis=1, keepdims=True), 1))


def fit(matrix, langs: list[str], landmark: list[bool]):
    """Landmarks, coefficients and the languages in their order."""
    import numpy as np

    names = sorted(set(langs))
    x = _normal(matrix)
    marks = x[np.array(landmark)]
    own, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    use = own > 1e-6 * own.max()
    root = vectors[:, use] / np.sqrt(own[use])
    phi = (x @ marks.T).astype(np.float64) @ root
    y = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    solved = np.linalg.solve(phi.T @ phi + RIDGE * np.eye(phi.shape[1]), phi.T @ y)
    return marks, (root @ solved).astype(np.float32), names


def _with_letters(docs: DataFrame, *more) -> DataFrame:
    return docs.select(*more, F.when(F.col("text").rlike(r"\p{L}"), F.col("text").cast("binary")).alias("raw"))


def train(docs: DataFrame):
    """A model from a bounded sample of rows with a language whose id is not held out; else None.

    Of each language the ``PER_LANGUAGE`` ids with the least hashes; null ids and texts without a
    letter teach nothing. An id counts once for a language, with the text of the least hash, however
    often its rows are repeated; so at most ``TRAIN_ROWS`` rows, a kilobyte each, come to the driver.
    """
    import numpy as np
    import pyarrow as pa

    rows = _with_letters(
        docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (id_remainder("doc_id", HELD_OUT_BY) != HELD_OUT)),
        "lang", "doc_id").where(F.col("raw").isNotNull()).select(
        F.col("lang").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("raw").alias("mark"), "raw")
    # Ranked without the texts; the few that are chosen are fetched by their ids.
    few = least_ids(rows, PER_LANGUAGE, TRAIN_ROWS)
    chosen = rows.join(F.broadcast(few), ["grp", "doc_id", "mark"]).select("grp", "n", "doc_id", "raw")

    def packed(batches):
        met = set()
        for batch in batches:
            keys = list(zip(batch.column("grp").to_pylist(), batch.column("doc_id").to_pylist()))
            new = [k for k, key in enumerate(keys) if not (key in met or met.add(key))]
            raws = batch.column("raw").take(pa.array(new, pa.int64())).to_pylist()
            bits = [np.packbits(r > 0).tobytes() for a, b in _slices(raws) for r in presence(raws[a:b])]
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(new, pa.int64())) for c in batch.columns[:3]], pa.array(bits, pa.binary())], names=["grp", "n", "doc_id", "bits"])

    schema = chosen.drop("raw").schema.add("bits", "binary")
    once = chosen.mapInArrow(packed, schema).dropDuplicates(["grp", "doc_id"])
    found = sorted(once.collect(), key=lambda r: (r["grp"], r["n"], r["bits"]))
    if not found:
        return None
    matrix = np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in found]).astype(np.float32)
    return fit(matrix, [r["grp"] for r in found], [r["n"] <= LANDMARKS for r in found])


def predict(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    The score is the winning regression's value, from [-1, 1] to [0, 1]. Null texts, texts without a
    letter, and all texts when there was nothing to learn from, are ``und`` with score 0. Null ids
    are not held out. Repeated rows each get their row; ties go to the first language by name; other
    columns are not looked at.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            raws = batch.column("raw").to_pylist()
            names, scores = [UNKNOWN] * len(raws), np.zeros(len(raws))
            real = [k for k, x in enumerate(raws) if x is not None] if model else []
            if real:
                marks, weights, langs = model
                some = [raws[k] for k in real]
                for a, b in _slices(some):
                    f = (_normal(presence(some[a:b])) @ marks.T) @ weights
                    best = f.argmax(axis=1)
                    for k, w, v in zip(real[a:b], best.tolist(), f.max(axis=1).tolist()):
                        names[k], scores[k] = langs[w], (min(1.0, max(-1.0, v)) + 1) / 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    held = (id_remainder("doc_id", HELD_OUT_BY) == HELD_OUT).alias("held_out")
    return _with_letters(docs, F.col("doc_id").cast("long").alias("doc_id"), held).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")
