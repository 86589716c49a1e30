"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text's features are the different runs of four and of five characters it has, hashed to a
fixed number of buckets. From labelled texts each bucket gets the log ratio of its smoothed
shares among toxic and other texts; logistic regression on features so scaled gives the
weights. The model is one number per bucket whatever the data, so scoring is a pass over the
texts without a shuffle.

Training takes a bounded sample of the labelled rows: ``SAMPLE_ROWS`` of them, picked by a
hash of the id, with their whole texts, however long. Counts of the buckets are made on Spark;
to the driver come one pair of counts per bucket and, of each text, the buckets whose ratio
tells something. Every text is scored whole, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import Packed, discard
from barweave.session import materialize

ORDERS = (4, 5)
BUCKET_BITS = 20
SAMPLE_ROWS = 8_000
THRESHOLD = 0.3
LEAST_TEXTS = 3  # that have a bucket for it to count
LEAST_RATIO = 1.0
SMOOTHING = 1.0
ROUNDS = 200
RATE = 0.05
PENALTY = 3.0  # over the number of texts learnt from


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learnt from: a quarter, by a checksum of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def buckets(text: str | None):
    """Bucket of every n-gram of a text, repeats included; case is ignored."""
    import numpy as np

    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le"), dtype=np.uint32)
    points = points.astype(np.uint64)
    factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BUCKET_BITS)
    found = []
    for order in ORDERS:
        count = len(points) - order + 1
        if count < 1:
            continue
        grams = np.full(count, np.uint64(order), dtype=np.uint64)
        for k in range(order):
            grams = grams * factor + points[k : k + count]
        grams ^= grams >> np.uint64(29)
        found.append((grams * np.uint64(0xBF58476D1CE4E5B9)) >> shift)
    return np.concatenate(found).astype(np.uint32) if found else np.zeros(0, dtype=np.uint32)


def ratios(held, among):
    """Log-count ratio of every bucket, and whether it tells enough to be used.

    From the numbers of texts, and of toxic ones, that have the bucket.
    """
    import numpy as np

    size, other = len(held), held - among
    ratio = np.log((among + SMOOTHING) / (among.sum() + SMOOTHING * size)) - np.log(
        (other + SMOOTHING) / (other.sum() + SMOOTHING * size)
    )
    return ratio, (held >= LEAST_TEXTS) & (np.abs(ratio) >= LEAST_RATIO)


class Model:
    """A bias and a weight per bucket."""

    def __init__(self, bias: float, weights):
        self.bias, self.weights = bias, weights

    def score(self, text: str | None) -> float:
        import numpy as np

        held = buckets(text)
        held = np.unique(held[self.weights[held] != 0])
        logit = self.bias + float(self.weights[held].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))

    @classmethod
    def fit(cls, features: list, toxic) -> Model:
        """From the different buckets of each text and its label (0 or 1)."""
        import numpy as np

        size = 1 << BUCKET_BITS
        held, among = np.zeros(size), np.zeros(size)
        for buckets_of, is_toxic in zip(features, toxic):
            held[buckets_of] += 1
            if is_toxic:
                among[buckets_of] += 1
        return cls.of_counts(features, toxic, *ratios(held, among))

    @classmethod
    def of_counts(cls, features: list, toxic, ratio, used) -> Model:
        """The same with ratios at hand; of the features only ``used`` ones matter."""
        import numpy as np

        toxic = np.asarray(toxic, dtype=np.float64)
        n, positive = len(toxic), float(toxic.sum())
        size = len(ratio)
        prior = (positive + 1) / (n + 2)
        bias = float(np.log(prior / (1 - prior)))
        weights = np.zeros(size, dtype=np.float32)
        if not 0 < positive < n:
            return cls(bias, weights)
        chosen = np.flatnonzero(used)
        place = np.zeros(size, dtype=np.int32)
        place[chosen] = np.arange(len(chosen))
        kept = [place[f[used[f]]] for f in features]
        column = np.concatenate(kept)
        row = np.repeat(np.arange(n, dtype=np.int32), [len(f) for f in kept])
        scale = ratio[chosen]
        value = scale[column]

        w, b = np.zeros(len(chosen)), bias
        first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
        for step in range(1, ROUNDS + 1):
            logit = np.bincount(row, value * w[column], n) + b
            error = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - toxic
            slope = np.bincount(column, value * error[row], len(chosen)) / n + PENALTY / n * w
            slope = np.append(slope, error.mean())
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
        weights[chosen] = w * scale
        return cls(float(b), weights)


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
) -> Model:
    """A model of labelled texts that are not held out.

    An id with several labels is toxic if one says so; null labels and ids are left out.
    Of an id that repeats the last text in order is taken. Without labels of both kinds every
    text gets the share of toxic ones as its score.
    """
    known = (
        labels.select(F.col(doc_id).alias("id"), F.col(label).cast("double").alias("toxic"))
        .dropna()
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # At most so many rows, by the parameter: the texts stay where they are.
    chosen = known.orderBy(F.md5(F.col("id").cast("string")), "id").limit(rows)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.max("text").alias("text"))

    def featured(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for toxic, one in zip(*(c.to_pylist() for c in batch.columns)):
                held = pa.array([np.unique(buckets(one)).astype(np.int32)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([toxic]), held], ["toxic", "held"])

    import numpy as np

    learnt = materialize(
        sample.select("toxic", "text").mapInArrow(featured, "toxic double, held array<int>")
    )
    # At most a row per bucket, a number that does not follow the data.
    counts = (
        learnt.select("toxic", F.explode("held").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("held"), F.sum((F.col("toxic") > 0).cast("int")).alias("among"))
        .toPandas()
    )
    held, among = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    held[counts["bucket"]], among[counts["bucket"]] = counts["held"], counts["among"]
    ratio, used = ratios(held, among)
    sent = docs.sparkSession.sparkContext.broadcast(used)

    def narrowed(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            own = [np.asarray(h, dtype=np.uint32) for h in batch.column(1).to_pylist()]
            own = [h[sent.value[h]].tobytes() for h in own]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.binary())], ["toxic", "held"]
            )

    found = learnt.mapInArrow(narrowed, "toxic double, held binary").toPandas()
    discard(learnt)
    # The order of rows must not change sums of floats between runs.
    found = found.sort_values(["held", "toxic"], kind="stable")
    features = [np.frombuffer(h, dtype=np.uint32) for h in found["held"]]
    return Model.of_counts(features, (found["toxic"].to_numpy() > 0).astype(float), ratio, used)


def score_toxicity(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    doc_id: str = "doc_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every row with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    The score depends on the text only. A null text counts as empty and gets the score of a
    text without n-grams that matter. A null id is not held out. Rows that repeat get the
    same score; an empty table stays empty. Columns of ``docs`` named like an added one are
    replaced.
    """
    made = ("held_out", "score", "predicted")
    packed = Packed(docs)
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        own = Model(*sent.value)
        return pd.Series([own.score(t) for t in texts], dtype="float64")

    scored = packed.rows.withColumn("score", score(packed[text]))
    return scored.select(
        *packed.back(made),
        held_out(packed[doc_id]).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
