"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters run over every place of the whole document, and each chunk
of 128 bytes is max-pooled; the filters reach over a chunk's end, so neighbouring chunks overlap and no
place is left out. A document's chunks are combined by maximum and mean, and a small dense network
turns them into one probability. It is trained on the whole texts of a bounded sample of labelled rows;
scoring reads every byte of every document, in the map tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import cells, column, field, numbered, row_key

CHUNK = 128
WIDTH = 8
EMBEDDING = 4
FILTERS = 16
HIDDEN = 16
#: The training sample: most labelled rows, and bytes after which no further row is taken.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 64 << 20
#: Passes over the sample, and least number of steps, which a small sample takes in more passes.
EPOCHS = 12
STEPS = 600
BATCH = 64
#: Chunks convolved together when scoring.
TOGETHER = 1024

REACH = WIDTH - 1


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 1 when divided by 3."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 3 == 1


def chunked(body: bytes) -> np.ndarray:
    """The text in rows of a chunk and what the filters reach behind it; an empty text is one empty chunk."""
    n = max(1, -(-len(body) // CHUNK))
    data = np.zeros(n * CHUNK + REACH, np.uint8)
    data[: len(body)] = np.frombuffer(body, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK + REACH)[::CHUNK]


def starting_model(rng) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    return {
        "embedding": normal(256, EMBEDDING, scale=0.5),
        "filters": normal(WIDTH * EMBEDDING, FILTERS, scale=(2 / (WIDTH * EMBEDDING)) ** 0.5),
        "shift": np.zeros(FILTERS, np.float32),
        "dense": normal(2 * FILTERS, HIDDEN, scale=(1 / FILTERS) ** 0.5),
        "dense_shift": np.zeros(HIDDEN, np.float32),
        "out": normal(HIDDEN, scale=(2 / HIDDEN) ** 0.5),
        "out_shift": np.zeros(1, np.float32),
    }


def windows(chunks: np.ndarray, model) -> np.ndarray:
    """The embedded bytes under the filters: (chunk, place, width x embedding)."""
    embedded = model["embedding"][chunks]
    view = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH, axis=1)
    return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(len(chunks), CHUNK, -1)


def pooled(chunks: np.ndarray, model) -> np.ndarray:
    """Max-pooled filters of each chunk."""
    out = [
        (windows(chunks[i : i + TOGETHER], model).reshape(-1, WIDTH * EMBEDDING) @ model["filters"])
        .reshape(-1, CHUNK, FILTERS)
        .max(axis=1)
        for i in range(0, len(chunks), TOGETHER)
    ]
    return np.maximum(np.concatenate(out) + model["shift"], 0)


def strongest(chunks: np.ndarray, model) -> tuple[np.ndarray, np.ndarray]:
    """Of each chunk and filter, the largest value and its place."""
    tops, places = [], []
    for i in range(0, len(chunks), TOGETHER):
        part = chunks[i : i + TOGETHER]
        pre = (windows(part, model).reshape(-1, WIDTH * EMBEDDING) @ model["filters"]).reshape(len(part), CHUNK, FILTERS)
        place = pre.argmax(axis=1)
        tops.append(np.take_along_axis(pre, place[:, None], axis=1)[:, 0])
        places.append(place)
    return np.concatenate(tops), np.concatenate(places)


def combined(chunk_values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Maximum and mean over the chunks of each document."""
    sizes = np.diff(np.r_[starts, len(chunk_values)])[:, None]
    most = np.maximum.reduceat(chunk_values, starts)
    return np.hstack([most, np.add.reduceat(chunk_values, starts) / sizes]).astype(np.float32)


def probability(values: np.ndarray, model) -> np.ndarray:
    hidden = np.maximum(values @ model["dense"] + model["dense_shift"], 0)
    logit = hidden @ model["out"] + model["out_shift"][0]
    return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """A network trained on chunks of labelled documents, by Adam on the logistic loss.

    Without rows of both labels there is nothing to tell apart, and all scores are the labels' share.
    """
    rng = np.random.default_rng(seed)
    model = starting_model(rng)
    share = (labels.sum() + 1) / (len(labels) + 2)
    model["out_shift"][:] = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        model["out"][:] = 0
        return model
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    steps = 0
    per_epoch = max(1, len(texts) // BATCH)
    epochs = max(EPOCHS, -(-STEPS // per_epoch))
    total = epochs * per_epoch
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for b in range(per_epoch):
            chosen = order[b * BATCH : (b + 1) * BATCH]
            chunks = np.concatenate([texts[i] for i in chosen])
            sizes = np.array([len(texts[i]) for i in chosen])
            starts = np.cumsum(np.r_[0, sizes[:-1]])
            doc_of = np.repeat(np.arange(len(chosen)), sizes)
            top, place = strongest(chunks, model)
            top = top + model["shift"]
            active = np.maximum(top, 0)
            values = combined(active, starts)
            hidden = np.maximum(values @ model["dense"] + model["dense_shift"], 0)
            p = probability(values, model).astype(np.float32)
            # Backward.
            d_logit = (p - labels[chosen]).astype(np.float32) / len(chosen)
            grad = {"out": hidden.T @ d_logit, "out_shift": d_logit.sum(keepdims=True)}
            d_hidden = np.outer(d_logit, model["out"]) * (hidden > 0)
            grad["dense"], grad["dense_shift"] = values.T @ d_hidden, d_hidden.sum(axis=0)
            d_values = d_hidden @ model["dense"].T
            most = values[:, :FILTERS]
            is_most = active == most[doc_of]
            ties = np.add.reduceat(is_most, starts, axis=0, dtype=np.float32)
            d_active = d_values[:, :FILTERS][doc_of] * is_most / ties[doc_of]
            d_active = d_active + (d_values[:, FILTERS:] / sizes[:, None])[doc_of]
            d_top = (d_active * (top > 0)).astype(np.float32)
            grad["shift"] = d_top.sum(axis=0)
            grad["filters"] = np.empty_like(model["filters"])
            d_embedding = np.zeros_like(model["embedding"])
            for f in range(FILTERS):
                # Only the winning place of a chunk learns.
                moved = np.flatnonzero(d_top[:, f])
                at = chunks[moved[:, None], place[moved, f][:, None] + np.arange(WIDTH)]
                under = model["embedding"][at].reshape(len(moved), -1)
                grad["filters"][:, f] = under.T @ d_top[moved, f]
                weights = model["filters"][:, f].reshape(WIDTH, EMBEDDING)
                for w in range(WIDTH):
                    each = np.bincount(at[:, w], weights=d_top[moved, f], minlength=256).astype(np.float32)
                    d_embedding += each[:, None] * weights[w]
            grad["embedding"] = d_embedding
            steps += 1
            rate = 0.01 * (1 - (steps - 1) / total) + 0.0005
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                move = first[k] / (1 - 0.9**steps) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-8)
                model[k] = (model[k] - rate * move).astype(np.float32)
    return model


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int
) -> DataFrame:
    """doc_id, label and chunks of at most `most` labelled rows, those first by a hash of their id, up to the
    one with which their texts have SAMPLE_BYTES.

    A row labelled several times counts as its lowest label; a label that is no number is none. The chunks
    are cut in the tasks.
    """
    known = labels.select(column(id_col).alias("doc_id"), column(label_col).try_cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
    texts = docs.select(
        column(id_col).alias("doc_id"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    ).where(~held_out(F.col("doc_id")))
    sizes = texts.groupBy("doc_id").agg(F.max(F.octet_length("body")).alias("size"))
    chosen = known.groupBy("doc_id").agg(F.min("label").alias("label")).join(sizes, "doc_id")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # A window over at most `most` rows.
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    chosen = chosen.withColumn("taken", F.coalesce(F.sum("size").over(before), F.lit(0)))
    chosen = chosen.where(F.col("taken") < SAMPLE_BYTES).select("doc_id", "label")
    # At most `most` rows, so the join may broadcast them.
    found = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "body")

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            cut = [chunked(body).tobytes() for body in cells(batch, "body")]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": field(batch, "doc_id"), "label": field(batch, "label"), "chunks": pa.array(cut, pa.binary())}
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    parts = found.mapInArrow(rows, f"doc_id {id_type}, label int, chunks binary")
    # Rows that repeat an id: the first text in byte order.
    return parts.groupBy("doc_id", "label").agg(F.min("chunks").alias("chunks"))


def trained(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most: int = SAMPLE_ROWS,
) -> dict[str, np.ndarray]:
    """The network, trained by one task on the bounded sample; only its weights come to the driver."""

    def fit(batches):
        import io

        import pyarrow as pa

        rows = [r for batch in batches for r in batch.to_pylist()]
        rows.sort(key=lambda r: (str(r["doc_id"]), r["label"]))
        texts = [np.frombuffer(r["chunks"], np.uint8).reshape(-1, CHUNK + REACH) for r in rows]
        model = train(texts, np.array([min(1, max(0, r["label"])) for r in rows], np.float32))
        held = io.BytesIO()
        np.savez(held, **model)
        yield pa.RecordBatch.from_pydict({"model": pa.array([held.getvalue()], pa.binary())})

    import io

    sample = labelled_sample(docs, labels, id_col, text_col, label_col, most)
    # One partition of at most `most` small rows; an empty one trains too.
    row = sample.coalesce(1).mapInArrow(fit, "model binary").first()
    if row is None:
        return train([], np.zeros(0, np.float32))
    with np.load(io.BytesIO(row["model"])) as model:
        return dict(model)


def scores_of(bodies, model) -> np.ndarray:
    """The probability of each text; long texts are convolved in parts."""
    values, starts, total = [], [], 0
    waiting, held = [], 0
    for body in bodies:
        rows = chunked(body)
        starts.append(total)
        total += len(rows)
        waiting.append(rows)
        held += len(rows)
        if held >= TOGETHER:
            values += [pooled(r, model) for r in ([np.concatenate(waiting)] if len(waiting) > 1 else waiting)]
            waiting, held = [], 0
    if waiting:
        values.append(pooled(np.concatenate(waiting), model))
    if not starts:
        return np.zeros(0)
    return probability(combined(np.concatenate(values), np.array(starts)), model)


def quality_scores(
    docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: row_key, doc_id, held_out, score, predicted.

    A missing text scores as an empty one. A missing id is not held out, and not learned from. An
    empty table gives no rows.
    """
    texts = docs.select(
        row_key(docs).alias("row_key"),
        column(id_col).alias("doc_id"),
        held_out(column(id_col)).alias("held_out"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            names = ("row_key", "doc_id", "held_out")
            score = scores_of(cells(batch, "body"), model)
            yield pa.RecordBatch.from_pydict(
                {**{n: field(batch, n) for n in names}, "score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        rows, f"row_key string, doc_id {id_type}, held_out boolean, score double, predicted int"
    )


def drop_low_quality(docs: DataFrame, model: dict, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of `docs` that score at least `least`, with all columns; filtered where they are scored."""
    rows_of, name = numbered(docs, text_col)

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(scores_of(cells(batch, name), model) >= least))

    kept = rows_of.mapInArrow(rows, rows_of.schema)
    return kept.select(kept.columns[: len(docs.columns)]).toDF(*docs.columns)
