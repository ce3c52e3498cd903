"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text are its words, pairs of neighbours and pairs with one word
between, each hashed to one of ``2 ** BITS`` coordinates and counted once.
Every coordinate has a learning rate of its own, and the L1 term keeps all but
the telling ones at exactly zero, so that the model is a short list of weights.

Training takes a bounded sample of the labelled rows, those of equal text and
label as one row with their number, dealt to groups of about ``GROUP_ROWS`` rows and
``GROUP_BYTES`` of features at most on average, which learn side by side; the model is
the mean of their weights. Labels meet texts by id and two hashes; only the texts
drawn are read again, by a list of their hashes that the sample's bound limits, and
what is shuffled of them are their features (one text has ``2 ** BITS`` at most).
Scores are computed where the texts lie."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, utf8
from .words import ALNUM, Words, join_hashes

BITS = 20
#: The most rows that training takes (copies are one row), those that one group
#: learns from (about), and how often it does.
TRAINING_ROWS, GROUP_ROWS, EPOCHS = 48_000, 16_000, 5
#: Bytes of features (four each) that one group holds, about.
GROUP_BYTES = 96 << 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.01


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate) of every feature, repeats included."""
    h, row = words.hash, words.row
    rows, marks = [row], [h]
    for distance in (1, 2):
        if len(h) > distance:
            inside = row[distance:] == row[:-distance]
            rows.append(row[distance:][inside])
            marks.append(join_hashes(h[:-distance][inside] + np.uint64(distance), h[distance:][inside]))
    return np.concatenate(rows), (np.concatenate(marks) >> np.uint64(64 - BITS)).astype(np.int64)


def _by_text(texts: pa.Array):
    """(number of texts, row, coordinate) slice by slice."""
    buf, offsets = utf8(texts)
    for a, b in slices(offsets):
        words = Words(buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], ALNUM)
        yield b - a, *features(words)


def learn(documents: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, copies: np.ndarray | None = None) -> np.ndarray:
    """Weights by coordinate, the last one the bias. The copies of a document
    follow each other; once it has nothing to teach, neither have those left."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(documents)).tolist():
            at = documents[k]
            for _ in range(1 if copies is None else copies[k]):
                zi, ni = z[at], n[at]
                w = weights(zi, ni)
                g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - labels[k]
                if abs(g) < 1e-3:
                    break
                root = np.sqrt(ni)
                z[at] = zi + g - (np.sqrt(ni + g * g) - root) / ALPHA * w
                n[at] = ni + g * g
    return weights(z, n)


def _text_keys() -> list[Column]:
    return [F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h2")]


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``h, h2, label, n``: distinct labelled texts by two hashes, and how many rows
    have them. Both sides are counted before they meet, so that an id that many rows
    share on both sides is one row on each."""
    texts = (docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", *_text_keys())
             .groupBy("doc_id", "h", "h2").agg(F.count(F.lit(1)).alias("rows")))
    given = (labels.where("label IS NOT NULL").select("doc_id", F.col("label").cast("int").alias("label"))
             .groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("times")))
    met = texts.join(given, "doc_id").groupBy("h", "h2", "label").agg(F.sum(F.col("rows") * F.col("times")).alias("n"))
    return stored(met, "labelled")


def sample(distinct: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """At most ``training_rows`` rows of :func:`labelled`: those of the smallest hashes."""
    n = distinct.count()
    if n <= training_rows:
        return distinct
    below = F.col("h") < int(-(1 << 63) + min(0.99, (training_rows + 10 * training_rows ** 0.5 + 10) / n) * (1 << 64))
    hashes = np.sort(distinct.where(below).select("h").toArrow()["h"].to_numpy())  # a few more than wanted
    return distinct.where(F.col("h") < int(hashes[training_rows])) if len(hashes) > training_rows else distinct.where(below)


def training_features(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``h, h2, label, n, features``: the distinct coordinates of each chosen text
    (int32). The chosen rows are at most TRAINING_ROWS: a bounded broadcast."""
    def run(batches):
        for b in batches:
            out = []
            for count, row, at in _by_text(b.column("text")):
                pairs = np.unique((row << (BITS + 1)) | at)
                cut = np.searchsorted(pairs >> (BITS + 1), np.arange(1, count))
                out += [(d & ((1 << (BITS + 1)) - 1)).astype("<i4").tobytes() for d in np.split(pairs, cut)]
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("h2"), pa.array(out, pa.binary())], ["h", "h2", "features"])

    wanted = F.broadcast(chosen.select("h", "h2").distinct())
    texts = docs.where("text IS NOT NULL").select("text", *_text_keys()).join(wanted, ["h", "h2"], "left_semi")
    # copies of a text leave a task as one row
    rows = texts.select("h", "h2", "text").mapInArrow(run, "h long, h2 long, features binary")
    once = rows.groupBy("h", "h2").agg(F.any_value("features").alias("features"))
    return stored(once.join(F.broadcast(chosen), ["h", "h2"]), "features")


def train(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS,
          group_rows: int = GROUP_ROWS, group_bytes: int = GROUP_BYTES) -> dict[int, float]:
    """Weights that aren't zero, learnt of the texts of ``docs(doc_id, text)`` that
    ``labels(doc_id, label)`` name.

    The rows taken are chosen by the hash of their text. Null labels, ids and texts
    are left out; without rows, or with one label only, what is learnt is the
    bias."""
    chosen = training_features(docs, stored(sample(labelled(docs, labels), training_rows), "chosen"))
    size = chosen.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("features")).alias("bytes")).first()
    shards = max(1, round(size["n"] / group_rows), -(-(size["bytes"] or 0) // group_bytes))
    dealt = chosen.withColumn("shard", F.pmod("h2", F.lit(shards)).cast("int"))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("h2", "ascending"), ("label", "ascending")])  # one order, whatever came first
        docs = [np.append(np.frombuffer(x.as_buffer(), "<i4"), np.int32(1 << BITS)) for x in table.column("features")]
        w = learn(docs, table.column("label").to_numpy().astype(float), copies=table.column("n").to_numpy())
        at = np.flatnonzero(w)
        return pa.table({"at": pa.array(at, pa.int64()), "w": w[at]})

    fitted = dealt.groupBy("shard").applyInArrow(fit, "at long, w double")
    summed = fitted.groupBy("at").agg((F.sum("w") / shards).alias("w")).collect()  # at most 2 ** BITS + 1 rows
    return {r["at"]: r["w"] for r in summed}


def score(docs: DataFrame, model: dict[int, float], keep: list[Column] | None = None) -> DataFrame:
    """``docs`` narrowed to ``keep`` (columns) and ``score``, 0 to 1. A null or
    empty text has no features: its score is that of the bias."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((np.array(list(model), np.int64), np.array(list(model.values()))))
    kept = docs.select(*(keep or []), F.col("text").alias("_text"))
    schema = kept.drop("_text").schema.add("score", "double")

    def run(batches):
        w = np.zeros((1 << BITS) + 1)
        w[shared.value[0]] = shared.value[1]
        for b in batches:
            sums = []
            for count, row, at in _by_text(b.column("_text")):
                telling = w[at] != 0
                pairs = np.unique((row[telling] << (BITS + 1)) | at[telling])
                sums.append(np.bincount(pairs >> (BITS + 1), w[pairs & ((1 << (BITS + 1)) - 1)], count))
            total = np.concatenate(sums) if sums else np.zeros(0)
            p = 1 / (1 + np.exp(-np.clip(total + w[-1], -30, 30)))
            columns = [b.column(k) for k in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(p)], [*b.schema.names[:-1], "score"])

    return kept.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", folds: int = 5) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Rows whose crc32(id as text) leaves 0 when divided by ``folds`` are held
    out: no label of theirs is learnt from. A null id is not held out and has
    no label. Repeated labels of an id are learnt from as often; an empty table
    gives an empty result, and no labels at all give scores of 0.5."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
    model = train(docs.where(~held), known)
    scored = score(docs, model, [F.col("doc_id"), held.alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
